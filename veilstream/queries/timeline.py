"""Queries of replay, checks, cuts, cascades, fingerprints and apportionment, and their SQL.

The table ``events`` stands in for a ledger: history_id = event_id, one transaction per five events at the
latest of their times, key user_id, table event_type, op I for a key's first event, D where event_id ends in 9,
else U.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import apportion, cascade, fingerprint, identify, ledger
from .repair import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_OP = "CASE WHEN event_id % 10 = 9 THEN 'D' WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 THEN 'I' ELSE 'U' END"
_LEDGER = f"""
ledger AS (
  SELECT event_id AS history_id, event_id // 5 AS txid, max(ts) OVER (PARTITION BY event_id // 5) AS tx_at, ts AS stmt_at, {_OP} AS op, event_type AS table_name, user_id, value, props FROM events
)"""
#: A point in the ledger's time span; all three scales reach beyond it.
_AT = "(SELECT quantile_disc(ts, 0.5) FROM events)"


def event_ledger(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "events")
    tx = F.floor(F.col("event_id") / 5)
    ends = df.groupBy(tx.alias("txid")).agg(F.max("ts").alias("tx_at"))
    first = df.groupBy("user_id").agg(F.min("event_id").alias("_first"))
    rows = df.withColumn("txid", tx).join(ends, "txid").join(first, "user_id")
    op = F.when(F.col("event_id") % 10 == 9, "D").when(F.col("event_id") == F.col("_first"), "I").otherwise("U")
    return rows.select(F.col("event_id").alias("history_id"), "txid", "tx_at", F.col("ts").alias("stmt_at"), op.alias("op"), F.col("event_type").alias("table_name"), "user_id", "value", "props")


def _state_sql(where: str) -> str:
    return f"WITH {_LEDGER} SELECT user_id, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tx_at DESC, history_id DESC) AS rn FROM ledger {where}) WHERE rn = 1 AND op <> 'D'"


@query(_state_sql(""))
def ledger_latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.replay(event_ledger(spark, folder), ["user_id"], ["value", "props"])


@query(_state_sql(f"WHERE tx_at <= {_AT}"))
def ledger_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The state at the median instant."""
    middle = identify.at_rank(table(spark, folder, "events"), "ts", 0.5)
    return ledger.replay(event_ledger(spark, folder), ["user_id"], ["value", "props"], middle)


@query(f"WITH {_LEDGER} SELECT history_id, tx_at, previous FROM (SELECT history_id, tx_at, lag(tx_at) OVER (ORDER BY history_id) AS previous FROM ledger) WHERE previous > tx_at")
def ledger_inversions(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.inversions(event_ledger(spark, folder))


#: The ledger with every seventh transaction an hour early and every eleventh entry a second late.
_BENT = f"WITH {_LEDGER}, bent AS (SELECT * REPLACE (CASE WHEN txid % 7 = 0 THEN tx_at - INTERVAL 1 HOUR ELSE tx_at END + CASE WHEN history_id % 11 = 0 THEN INTERVAL 1 SECOND ELSE INTERVAL 0 SECOND END AS tx_at) FROM ledger)"


def bent_ledger(spark: SparkSession, folder: str) -> DataFrame:
    early = F.when(F.col("txid") % 7 == 0, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    late = F.when(F.col("history_id") % 11 == 0, F.expr("INTERVAL 1 SECOND")).otherwise(F.expr("INTERVAL 0 SECOND"))
    return event_ledger(spark, folder).withColumn("tx_at", F.col("tx_at") - early + late)


@query(_BENT + " SELECT history_id, tx_at, previous FROM (SELECT history_id, tx_at, lag(tx_at) OVER (ORDER BY history_id) AS previous FROM bent) WHERE previous > tx_at")
def ledger_inversions_bent(spark: SparkSession, folder: str) -> DataFrame:
    """The same check where there is something to find."""
    return ledger.inversions(bent_ledger(spark, folder))


@query(_BENT + " SELECT txid, count(DISTINCT tx_at) AS n_instants FROM bent GROUP BY 1 HAVING count(DISTINCT tx_at) > 1")
def split_txns(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.split_transactions(bent_ledger(spark, folder))


@query(_BENT + " SELECT tx_at, count(DISTINCT txid) AS n_transactions FROM bent GROUP BY 1 HAVING count(DISTINCT txid) > 1")
def shared_instants(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.shared_instants(bent_ledger(spark, folder))


@query(f"WITH {_LEDGER} SELECT date_trunc('hour', tx_at) AS tx_at, count(DISTINCT txid) AS n_transactions FROM ledger GROUP BY 1 HAVING count(DISTINCT txid) > 1")
def shared_instants_bent(spark: SparkSession, folder: str) -> DataFrame:
    """The same check where there is something to find: a ledger that knows hours only."""
    return ledger.shared_instants(event_ledger(spark, folder).withColumn("tx_at", F.date_trunc("hour", "tx_at").cast("timestamp_ntz")))


@query(f"WITH {_LEDGER} SELECT row_number() OVER (ORDER BY stmt_at, table_name, history_id) AS place, history_id, table_name FROM ledger")
def ledger_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """All entries by statement, table and number, without a sort in one task."""
    rows = event_ledger(spark, folder).select("history_id", "table_name", "stmt_at")
    return identify.dense_ids(rows, ["stmt_at", "table_name", "history_id"], "place").drop("stmt_at")


@query("SELECT row_number() OVER (ORDER BY l_orderkey::VARCHAR, l_linenumber::VARCHAR) AS place, l_orderkey, l_linenumber FROM lineitem")
def keys_as_text(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the order of their keys as texts: 10 comes before 9."""
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("_a"), F.col("l_linenumber").cast("string").alias("_b"))
    return identify.dense_ids(df, ["_a", "_b"], "place").drop("_a", "_b")


@query(f"WITH {_LEDGER} SELECT txid, count(DISTINCT table_name) AS n_tables, count(*) AS n_entries FROM ledger GROUP BY 1 HAVING count(DISTINCT table_name) > 1")
def multi_table_txns(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.wide_transactions(event_ledger(spark, folder))


@query(f"WITH {_LEDGER} SELECT table_name, op, count(*) AS n_entries, count(DISTINCT txid) AS n_transactions, count(DISTINCT tx_at) AS n_instants, min(tx_at) AS first_at, max(tx_at) AS last_at FROM ledger GROUP BY 1, 2")
def timeline_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.summary(event_ledger(spark, folder))


@query(_BENT + " SELECT user_id, count(*) AS n_late FROM (SELECT user_id, tx_at, lag(tx_at) OVER (PARTITION BY user_id ORDER BY history_id) AS p FROM bent) WHERE p > tx_at GROUP BY 1")
def late_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.late_arrivals(bent_ledger(spark, folder), ["user_id"])


@query(
    f"WITH {_LEDGER}, replayed AS (SELECT user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tx_at DESC, history_id DESC) AS rn FROM ledger) WHERE rn = 1 AND op <> 'D'),"
    " live AS (SELECT user_id, CASE WHEN user_id % 50 = 3 THEN value + 1 ELSE value END AS value FROM replayed WHERE user_id % 40 <> 1)"
    " SELECT *, 'ledger' AS side FROM (SELECT * FROM replayed EXCEPT ALL SELECT * FROM live) UNION ALL SELECT *, 'live' FROM (SELECT * FROM live EXCEPT ALL SELECT * FROM replayed)"
)
def ledger_vs_live_except_all(spark: SparkSession, folder: str) -> DataFrame:
    """Replayed state against a live copy with lost and changed rows."""
    state = ledger.replay(event_ledger(spark, folder), ["user_id"], ["value"])
    live = state.where("user_id % 40 <> 1").withColumn("value", F.when(F.col("user_id") % 50 == 3, F.col("value") + 1).otherwise(F.col("value")))
    return ledger.difference(state, live)


_LOG = f"{_LEDGER}, log AS (SELECT table_name AS topic, history_id % 3 AS partition, history_id AS \"offset\", (epoch_us(tx_at) // 1000) AS ts_ms, txid, user_id FROM ledger), cut AS (SELECT topic, partition, coalesce(min(CASE WHEN ts_ms > (epoch_us({_AT}) // 1000) THEN \"offset\" END), max(\"offset\") + 1) AS cut_offset FROM log GROUP BY 1, 2)"


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_ledger(spark, folder)
    return rows.select(F.col("table_name").alias("topic"), (F.col("history_id") % 3).alias("partition"), F.col("history_id").alias("offset"), F.unix_millis(F.col("tx_at").cast("timestamp")).alias("ts_ms"), "txid", "user_id")


def _middle_ms(spark: SparkSession, folder: str) -> int:
    ms = table(spark, folder, "events").select(F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    return int(identify.at_rank(ms, "at", 0.5) or 0)


@query(f"WITH {_LOG} SELECT * FROM cut")
def offset_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.manifest(event_log(spark, folder), _middle_ms(spark, folder))


@query(f"WITH {_LOG}, marked AS (SELECT log.*, \"offset\" < cut_offset AS inside FROM log JOIN cut USING (topic, partition)) SELECT topic, partition, \"offset\", ts_ms, txid, user_id FROM marked WHERE inside AND txid NOT IN (SELECT txid FROM marked WHERE NOT inside)")
def snap_to_txn(spark: SparkSession, folder: str) -> DataFrame:
    log = event_log(spark, folder)
    return ledger.snap_to_transactions(log, ledger.manifest(log, _middle_ms(spark, folder)))


@query(
    f"WITH {_LEDGER}, log AS (SELECT table_name AS topic, history_id % 3 AS partition, history_id AS \"offset\", (epoch_us(tx_at) // 1000) AS ts_ms, txid, user_id, op, value FROM ledger), cut AS (SELECT topic, partition,"
    f" coalesce(min(CASE WHEN ts_ms > (epoch_us({_AT}) // 1000) THEN \"offset\" END), max(\"offset\") + 1) AS cut_offset FROM log GROUP BY 1, 2), marked AS (SELECT log.*, \"offset\" < cut_offset AS inside FROM log JOIN cut USING (topic, partition)),"
    " kept AS (SELECT * FROM marked WHERE inside AND txid NOT IN (SELECT txid FROM marked WHERE NOT inside))"
    " SELECT topic, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY topic, user_id ORDER BY ts_ms DESC, \"offset\" DESC) AS rn FROM kept) WHERE rn = 1 AND op <> 'D'"
)
def restore_at(spark: SparkSession, folder: str) -> DataFrame:
    """The state at the median instant: guarded, cut, snapped to whole transactions, replayed."""
    log = event_log(spark, folder).join(event_ledger(spark, folder).select(F.col("history_id").alias("offset"), "op", "value"), "offset")
    edges = log.agg(F.min("ts_ms").alias("low"), F.max("ts_ms").alias("high")).first()
    at = _middle_ms(spark, folder)
    return ledger.restore(log, at, min(edges["low"] or 0, at), max(edges["high"] or 0, at), ["topic", "user_id"], ["value"])


# --- references -------------------------------------------------------------------------------------------

_CHAIN = (
    cascade.Reference("orders", "o_orderkey", "o_custkey", "customer", cascade.CASCADE),
    cascade.Reference("lineitem", "l_id", "l_orderkey", "orders", cascade.CASCADE),
)


def _chain(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lines = table(spark, folder, "lineitem").select("l_orderkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("l_id"))
    return {"customer": table(spark, folder, "customer").select("c_custkey"), "orders": table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "lineitem": lines}


@query(
    "WITH c AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), o AS (SELECT o_orderkey FROM orders SEMI JOIN c ON o_custkey = c_custkey)"
    " SELECT 'customer' AS table_name, c_custkey AS row_id, 'D' AS op, '' AS field, 0 AS depth FROM c UNION ALL SELECT 'orders', o_orderkey, 'D', '', 1 FROM o"
    " UNION ALL SELECT DISTINCT 'lineitem', l_orderkey * 8 + l_linenumber, 'D', '', 2 FROM lineitem SEMI JOIN o ON l_orderkey = o_orderkey"
)
def cascade_delete_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """All deletes that follow from deleting the customers in debt."""
    doomed = table(spark, folder, "customer").where("c_acctbal < 0").select(F.lit("customer").alias("table_name"), F.col("c_custkey").alias("row_id"))
    return cascade.consequences(_chain(spark, folder), _CHAIN, doomed)


@query(
    "SELECT 'lineitem' AS table_name, l_orderkey * 8 + l_linenumber AS row_id, 'D' AS op, 0 AS step FROM lineitem UNION ALL SELECT 'orders', o_orderkey, 'D', 1 FROM orders UNION ALL SELECT 'customer', c_custkey, 'D', 2 FROM customer"
)
def delete_all_events(spark: SparkSession, folder: str) -> DataFrame:
    """One delete per row of all tables, referring rows before those they refer to."""
    return cascade.delete_all(_chain(spark, folder), _CHAIN)


@query(
    "WITH a AS (SELECT DISTINCT appointment_id FROM appointments WHERE status = 'cancelled'), c AS (SELECT DISTINCT claim_id FROM claims SEMI JOIN a USING (appointment_id)), n AS (SELECT DISTINCT note_id FROM notes SEMI JOIN a USING (appointment_id))"
    " SELECT 'appointments' AS table_name, appointment_id AS row_id, 'D' AS op, '' AS field, 0 AS depth FROM a UNION ALL SELECT 'claims', claim_id, 'D', '', 1 FROM c UNION ALL SELECT 'notes', note_id, 'U', 'appointment_id', 1 FROM n"
)
def set_null_as_update(spark: SparkSession, folder: str) -> DataFrame:
    """Deleting cancelled appointments deletes their claims and detaches their notes."""
    tables = {n: table(spark, folder, n) for n in ("appointments", "claims", "notes")}
    doomed = tables["appointments"].where("status = 'cancelled'").select(F.lit("appointments").alias("table_name"), F.col("appointment_id").alias("row_id"))
    return cascade.consequences(tables, cascade.CLINIC, doomed)


@query("SELECT DISTINCT appointment_id FROM appointments a WHERE EXISTS (SELECT 1 FROM claims c WHERE c.appointment_id = a.appointment_id) AND EXISTS (SELECT 1 FROM notes n WHERE n.appointment_id = a.appointment_id)")
def detach_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Appointments with both a claim and a note."""
    visits = table(spark, folder, "appointments").select("appointment_id").distinct()
    for other in ("claims", "notes"):
        visits = visits.join(table(spark, folder, other).select("appointment_id"), "appointment_id", "left_semi")
    return visits


@query("SELECT o_orderkey, count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(l_orderkey) BETWEEN 1 AND 5")
def purge_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with one to five lines; lines are counted before they meet the orders."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    return table(spark, folder, "orders").select("o_orderkey").join(lines.where(F.col("n_lines").between(1, 5)), "o_orderkey")


@query("SELECT coalesce(max(regexp_extract(upper(replace(mrn, ' ', '')), '^MRN-([0-9]+)$', 1)::BIGINT), 0) + 1 AS next_mrn FROM (SELECT mrn FROM patients WHERE regexp_full_match(upper(replace(mrn, ' ', '')), 'MRN-[0-9]+'))")
def next_mrn(spark: SparkSession, folder: str) -> DataFrame:
    tidy = F.upper(F.replace(F.col("mrn"), F.lit(" "), F.lit("")))
    rows = table(spark, folder, "patients").where(tidy.rlike("^MRN-[0-9]+$"))
    return rows.agg((F.coalesce(F.max(F.substring(tidy, F.lit(5), F.length(tidy)).cast("bigint")), F.lit(0)) + 1).alias("next_mrn"))


@query("SELECT provider_id, npi, full_name, specialty FROM (SELECT *, row_number() OVER (PARTITION BY provider_id ORDER BY loaded_at, npi) AS rn FROM providers) WHERE rn = 1 ORDER BY provider_id LIMIT 1")
def lookup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """A point lookup with projection: the first provider."""
    df = table(spark, folder, "providers")
    first = df.agg(F.min("provider_id").alias("m")).scalar()
    return df.where(F.col("provider_id") == first).orderBy("loaded_at", "npi").select("provider_id", "npi", "full_name", "specialty").limit(1)


@query("SELECT note_id, authored_at FROM notes WHERE NOT is_amended AND signed_at IS NOT NULL")
def unamended_notes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "notes").where("NOT is_amended AND signed_at IS NOT NULL").select("note_id", "authored_at")


@query("SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ', ') AS segments FROM customer GROUP BY 1")
def ordered_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Values joined into one text in order."""
    return table(spark, folder, "customer").groupBy("c_nationkey").agg(F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ", ").alias("segments"))


@query("SELECT c_name, c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS id FROM (SELECT reverse(c_name) AS c_name, c_custkey FROM customer)")
def assigned_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogate keys in the order of a natural key."""
    df = table(spark, folder, "customer").select(F.reverse("c_name").alias("c_name"), "c_custkey")
    return identify.dense_ids(df, ["c_name", "c_custkey"])


@query("SELECT s_suppkey, s_name, position('0' IN s_name) AS at FROM supplier WHERE s_name LIKE '%0%' AND s_name NOT LIKE '%!_%' ESCAPE '!' AND s_name NOT LIKE '%7' AND s_nationkey IN (1, 3, 5, 7, 9)")
def pattern_predicates(spark: SparkSession, folder: str) -> DataFrame:
    """Patterns with an escape, their negation, membership and position."""
    df = table(spark, folder, "supplier")
    keep = F.col("s_name").like("%0%") & F.expr("s_name NOT LIKE '%!_%' ESCAPE '!'") & ~F.col("s_name").like("%7") & F.col("s_nationkey").isin(1, 3, 5, 7, 9)
    return df.where(keep).select("s_suppkey", "s_name", F.instr("s_name", "0").alias("at"))


@query("SELECT appointment_id, json_extract_string(intake_answers, '$.reason') AS reason FROM (SELECT DISTINCT appointment_id, intake_answers FROM appointments WHERE json_valid(intake_answers)) WHERE json_extract_string(intake_answers, '$.reason') IS NOT NULL AND json_extract_string(intake_answers, '$.pain_scale') IS NULL")
def json_predicates(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with one field in their JSON and without another; what is no JSON has none."""
    df = table(spark, folder, "appointments").select("appointment_id", "intake_answers").distinct().withColumn("v", F.try_parse_json("intake_answers"))
    field = lambda name: F.try_variant_get("v", f"$.{name}", "string")
    return df.where(field("reason").isNotNull() & field("pain_scale").isNull()).select("appointment_id", field("reason").alias("reason"))


# --- fingerprints and apportionment --------------------------------------------------------------------------


@query("SELECT o_totalprice, o_orderdate, c_name AS customer FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def fk_to_natural_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return fingerprint.natural(orders, [("o_custkey", table(spark, folder, "customer"), "c_custkey", F.col("c_name"), "customer")], ["o_orderkey"])


def _hash_sql(columns: dict[str, str], source: str) -> str:
    parts = ", ".join(f"coalesce('{n}=' || length({e})::VARCHAR || ':' || {e}, '{n}~')" for n, e in sorted(columns.items()))
    sums = " || ':' || ".join(f"coalesce(sum(('0x' || substr(h, {15 * i + 1}, 15))::BIGINT::HUGEINT), 0)::VARCHAR" for i in range(4))
    return f"SELECT count(*) AS n_rows, sha256({sums}) AS digest FROM (SELECT sha256(concat_ws(chr(30), {parts})) AS h FROM {source})"


@query(_hash_sql({"c_acctbal": "c_acctbal::DECIMAL(38,2)::VARCHAR", "c_custkey": "c_custkey::VARCHAR", "c_mktsegment": "c_mktsegment", "c_name": "c_name", "c_nationkey": "c_nationkey::VARCHAR"}, "customer"))
def table_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "customer")
    return fingerprint.fingerprint(df.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(38,2)")))


@query("WITH w AS (SELECT p_partkey, p_size::DOUBLE * 7777 / (SELECT sum(p_size)::DOUBLE FROM part) AS q FROM part), r AS (SELECT p_partkey, floor(q) AS b, q - floor(q) AS f FROM w) SELECT p_partkey, (b + CASE WHEN row_number() OVER (ORDER BY f DESC, p_partkey) <= 7777 - (SELECT sum(b) FROM r) THEN 1 ELSE 0 END)::BIGINT AS share FROM r")
def largest_remainder(spark: SparkSession, folder: str) -> DataFrame:
    """7777 units shared out over the parts by their size."""
    return apportion.largest_remainder(table(spark, folder, "part").select("p_partkey", "p_size"), "p_partkey", F.col("p_size"), 7777).select("p_partkey", "share")


@query("SELECT event_id, user_id, make_timestamp(i + max(t - i) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)) AS ts FROM (SELECT event_id, user_id, epoch_us(date_trunc('day', ts)) AS t, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts), event_id) AS i FROM events)")
def spread_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a user on one day, kept a microsecond apart."""
    df = table(spark, folder, "events").select("event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"))
    return apportion.spread_instants(df, ["user_id"], "ts", "event_id")


_NAMES = """
pat AS (SELECT patient_id, min(mrn) AS patient FROM patients WHERE patient_id IS NOT NULL GROUP BY 1), prov AS (SELECT provider_id, min(npi) AS provider FROM providers WHERE provider_id IS NOT NULL GROUP BY 1),
vis AS (SELECT appointment_id, min(concat_ws('@', patient, scheduled_at)) AS visit FROM appointments LEFT JOIN pat USING (patient_id) WHERE appointment_id IS NOT NULL GROUP BY 1),
ams AS (SELECT note_id AS amends_note_id, min(concat_ws('@', patient, authored_at)) AS amends FROM notes LEFT JOIN pat USING (patient_id) WHERE note_id IS NOT NULL GROUP BY 1)"""
_AT_TEXT, _MONEY = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')", "{c}::DECIMAL(38,2)::VARCHAR"
_CLINIC_COLUMNS = {
    "providers": ("npi full_name specialty email created_at updated_at", "providers"),
    "patients": ("mrn first_name middle_name last_name date_of_birth ssn email phone address_line1 address_line2 city state postal_code created_at updated_at", "patients"),
    "appointments": ("patient provider scheduled_at checked_in_at completed_at duration_minutes status location_name intake_answers created_at updated_at", "appointments LEFT JOIN pat USING (patient_id) LEFT JOIN prov USING (provider_id)"),
    "claims": ("patient visit billed_amount allowed_amount paid_amount patient_responsibility diagnosis_codes procedure_code claim_status submitted_at adjudicated_at created_at updated_at", "claims LEFT JOIN pat USING (patient_id) LEFT JOIN vis USING (appointment_id)"),
    "notes": ("patient provider visit amends note_type body authored_at signed_at is_amended created_at updated_at", "notes LEFT JOIN pat USING (patient_id) LEFT JOIN prov USING (provider_id) LEFT JOIN vis USING (appointment_id) LEFT JOIN ams USING (amends_note_id)"),
}


def _clinic_hash_sql(only: str | None = None) -> str:
    how = {c: _MONEY for c in ("billed_amount", "allowed_amount", "paid_amount", "patient_responsibility")} | {"loaded_at": _AT_TEXT, "date_of_birth": "strftime({c}, '%Y-%m-%d')", "diagnosis_codes": "to_json({c})::VARCHAR"}
    each = []
    for name, (columns, source) in sorted(_CLINIC_COLUMNS.items()):
        exprs = {c: how.get(c, "{c}::VARCHAR").format(c=c) for c in [*columns.split(), "loaded_at"]}
        each.append(f"(SELECT '{name}' AS table_name, n_rows, digest FROM ({_hash_sql(exprs, '(SELECT * FROM ' + source + ')')}))")
    if only is not None:
        return f"WITH {_NAMES} SELECT n_rows, digest FROM {dict(zip(sorted(_CLINIC_COLUMNS), each))[only]}"
    union = " UNION ALL ".join(f"SELECT * FROM {e}" for e in each)
    return f"WITH {_NAMES}, each AS ({union}) SELECT * FROM each UNION ALL SELECT '*', sum(n_rows)::BIGINT, sha256(string_agg(table_name || ':' || n_rows || ':' || digest, chr(10) ORDER BY table_name)) FROM each"


@query(_clinic_hash_sql())
def database_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """All five tables by natural keys, every column of them, and the database as a whole."""
    names = ("providers", "patients", "appointments", "claims", "notes")
    return fingerprint.database(fingerprint.clinic({n: table(spark, folder, n) for n in names}))


@query(_clinic_hash_sql("claims"))
def claims_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Of the claims by natural keys: no surrogate key goes into it, every other column does."""
    return fingerprint.fingerprint(fingerprint.clinic({n: table(spark, folder, n) for n in ("providers", "patients", "appointments", "claims", "notes")})["claims"])
