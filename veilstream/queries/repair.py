"""Queries of the data-repair operators (p1, p2, p3, p5, p6) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import instant_millis, instant_seconds, read_instant
from ..operators import changefeed, history, intervals, orphans
from ..operators.latest import latest_by_key
from ..session import cut


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- p1: busy periods and gaps -------------------------------------------------------------


def appointment_intervals(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "appointments").select("appointment_id", "provider_id", "scheduled_at", "duration_minutes", "updated_at")
    last = latest_by_key(df, ["appointment_id"], [read_instant(F.col("updated_at"))], ["provider_id", "scheduled_at", "duration_minutes"])
    start = instant_seconds(F.col("scheduled_at"))
    last = last.where("provider_id IS NOT NULL AND duration_minutes > 0").select("provider_id", start.alias("start_s"), (start + F.col("duration_minutes").cast("bigint") * 60).alias("end_s"))
    return last.where("start_s IS NOT NULL")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.periods(appointment_intervals(spark, folder), "provider_id", "start_s", "end_s")


def p1_load(spark: SparkSession, folder: str) -> DataFrame:
    """Busy and idle time per provider."""
    return p1_found(spark, folder).groupBy("provider_id", "period_kind").agg(F.count(F.lit(1)).alias("n_periods"), F.sum(F.col("ends_at") - F.col("starts_at")).alias("total_s"), F.max(F.col("ends_at") - F.col("starts_at")).alias("longest_s"))


_ZONED_SQL = r"""try_cast(CASE WHEN regexp_full_match({c}, '\s*\d{{4}}-\d{{2}}-\d{{2}}[Tt ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?\s*([Zz]|[+-]\d{{2}}:?\d{{2}})\s*') THEN regexp_replace(upper(trim({c})), '([+-]\d{{2}})(\d{{2}})$', '\1:\2') END AS TIMESTAMPTZ)"""


def zoned_sql(c: str) -> str:
    return _ZONED_SQL.format(c=c)


_P1_SQL = f"""
WITH last AS (
  SELECT provider_id, epoch_us({zoned_sql('scheduled_at')}) // 1000000 AS s, duration_minutes AS d
  FROM (SELECT *, row_number() OVER (PARTITION BY appointment_id ORDER BY {zoned_sql('updated_at')} DESC NULLS LAST, loaded_at DESC) AS rn FROM appointments)
  WHERE rn = 1
), iv AS (SELECT provider_id, s, s + d * 60::BIGINT AS e FROM last WHERE provider_id IS NOT NULL AND s IS NOT NULL AND d > 0),
marked AS (
  SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY provider_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM iv
), grouped AS (SELECT *, sum(opens) OVER (PARTITION BY provider_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM marked),
busy AS (SELECT provider_id, g, min(s) AS s, max(e) AS e FROM grouped GROUP BY 1, 2),
gaps AS (SELECT provider_id, e AS s, lead(s) OVER (PARTITION BY provider_id ORDER BY s) AS e FROM busy),
p1 AS (SELECT provider_id, 'busy' AS period_kind, s AS starts_at, e AS ends_at FROM busy
UNION ALL SELECT provider_id, 'gap', s, e FROM gaps WHERE e IS NOT NULL)
"""


# --- p3: references to records that do not exist -------------------------------------------

CLINIC_KEYS = [
    orphans.ForeignKey("appointments", "appointment_id", "patient_id", "patients", "patient_id"),
    orphans.ForeignKey("appointments", "appointment_id", "provider_id", "providers", "provider_id"),
    orphans.ForeignKey("claims", "claim_id", "appointment_id", "appointments", "appointment_id"),
    orphans.ForeignKey("notes", "note_id", "appointment_id", "appointments", "appointment_id"),
]


def clinic_orphans(spark: SparkSession, folder: str) -> DataFrame:
    tables = {n: table(spark, folder, n) for n in ("patients", "providers", "appointments", "claims", "notes")}
    return orphans.orphans(tables, CLINIC_KEYS, table(spark, folder, "deletions"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return clinic_orphans(spark, folder).where("lineage = 'direct'").select("child_table", "ref_field", "child_id", "orphan_kind", "load_month").distinct()


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphans.orphan_report(clinic_orphans(spark, folder))


_P3_REFS = "\nUNION ALL\n".join(
    f"SELECT '{k.child}' AS child_table, '{k.field}' AS ref_field, '{k.parent}' AS parent_table, c.{k.child_id} AS child_id, c.{k.field} AS ref_id, l.child_loaded"
    f" FROM (SELECT DISTINCT {k.child_id}, {k.field} FROM {k.child} WHERE {k.field} IS NOT NULL) c JOIN (SELECT {k.child_id}, min(loaded_at) AS child_loaded FROM {k.child} GROUP BY 1) l USING ({k.child_id})"
    for k in CLINIC_KEYS
)
_P3_SQL = f"""
WITH refs AS ({_P3_REFS}),
parents AS (
  SELECT 'patients' AS parent_table, patient_id AS ref_id, min(loaded_at) AS parent_loaded FROM patients GROUP BY 2
  UNION ALL SELECT 'providers', provider_id, min(loaded_at) FROM providers GROUP BY 2
  UNION ALL SELECT 'appointments', appointment_id, min(loaded_at) FROM appointments GROUP BY 2
), gone AS (SELECT DISTINCT regexp_replace(lower(trim(source_table)), '^.*\\.', '') AS parent_table, row_id AS ref_id, true AS deleted FROM deletions),
judged AS (
  SELECT r.child_table, r.ref_field, r.child_id, r.ref_id, r.parent_table,
    CASE WHEN p.ref_id IS NULL AND g.deleted THEN 'deleted' WHEN p.ref_id IS NULL THEN 'missing' WHEN p.parent_loaded > r.child_loaded THEN 'late' END AS orphan_kind,
    strftime(r.child_loaded, '%Y-%m') AS load_month
  FROM refs r LEFT JOIN parents p ON r.parent_table = p.parent_table AND r.ref_id = p.ref_id LEFT JOIN gone g ON r.parent_table = g.parent_table AND r.ref_id = g.ref_id
), direct AS (SELECT * FROM judged WHERE orphan_kind IS NOT NULL),
lost AS (SELECT DISTINCT child_id FROM direct WHERE child_table = 'appointments' AND orphan_kind <> 'late'),
inherited AS (SELECT j.* FROM judged j JOIN lost ON j.parent_table = 'appointments' AND j.ref_id = lost.child_id WHERE coalesce(j.orphan_kind, 'late') = 'late')
"""


# --- p5: change feed -----------------------------------------------------------------------


def p5_state(spark: SparkSession, folder: str) -> DataFrame:
    """The claims as they stand after all changes."""
    return changefeed.resolve(table(spark, folder, "claim_changes"), "claim_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_state(spark, folder).select("claim_id", "source_lsn")


_P5_SQL = """
SELECT {columns} FROM (
  SELECT *, coalesce(after_row.claim_id, before_row.claim_id) AS k,
    row_number() OVER (PARTITION BY coalesce(after_row.claim_id, before_row.claim_id) ORDER BY source_lsn DESC, (op <> 'd') DESC, transaction_order DESC NULLS LAST, ts_ms DESC NULLS LAST, topic_offset DESC) AS rn
  FROM claim_changes) WHERE rn = 1 AND op <> 'd'
"""


# --- p6: history of attributes -------------------------------------------------------------


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Versions by merges of slices of time, each into the versions current before it."""
    found = history.fold(table(spark, folder, "patient_extracts"), "patient_id", ["email", "postal_code"], instant_millis(F.col("updated_at")))
    return found.select("patient_id", "valid_from_ms", "valid_to_ms")


def p6_merged_late(spark: SparkSession, folder: str) -> DataFrame:
    """The same versions by merges of what arrived together, so that each brings late observations."""
    extracts = table(spark, folder, "patient_extracts")
    arrived = F.unix_millis(F.col("loaded_at").cast("timestamp"))
    middle = int(extracts.select(arrived.alias("at")).approxQuantile("at", [0.5], 0.01)[0]) if not extracts.isEmpty() else 0
    seen = None
    for part in (extracts.where(arrived < middle), extracts.where(F.coalesce(arrived, F.lit(middle)) >= middle)):
        seen = cut(history.merge_history(seen, part, "patient_id", ["email", "postal_code"], instant_millis(F.col("updated_at"))))
    return history.versions(seen, "patient_id", ["email", "postal_code"]).select("patient_id", "valid_from_ms", "valid_to_ms")


_P6_SQL = f"""
WITH seen AS (
  SELECT DISTINCT patient_id, epoch_us({zoned_sql('updated_at')}) // 1000 AS at_ms, coalesce(nullif(lower(trim(email, E' \\t\\r\\n')), ''), chr(1)) || chr(2) || coalesce(nullif(lower(trim(postal_code, E' \\t\\r\\n')), ''), chr(1)) AS pair
  FROM patient_extracts WHERE {zoned_sql('updated_at')} IS NOT NULL
), starts AS (SELECT * FROM (SELECT *, lag(pair) OVER (PARTITION BY patient_id ORDER BY at_ms) AS prev FROM seen) WHERE prev IS NULL OR prev <> pair)
SELECT patient_id, at_ms AS valid_from_ms, coalesce(lead(at_ms) OVER (PARTITION BY patient_id ORDER BY at_ms), -1) AS valid_to_ms FROM starts
"""

QUERIES = {"p1_found": p1_found, "p1_load": p1_load, "p3_found": p3_found, "p3_report": p3_report, "p5_found": p5_found, "p5_state": p5_state, "p6_found": p6_found, "p6_merged_late": p6_merged_late}
SQL = {
    "p1_found": _P1_SQL + "SELECT * FROM p1",
    "p1_load": _P1_SQL + "SELECT provider_id, period_kind, count(*) AS n_periods, sum(ends_at - starts_at)::BIGINT AS total_s, max(ends_at - starts_at) AS longest_s FROM p1 GROUP BY 1, 2",
    "p3_found": _P3_SQL + "SELECT DISTINCT child_table, ref_field, child_id, orphan_kind, load_month FROM direct",
    "p3_report": _P3_SQL
    + "SELECT child_table, ref_field, orphan_kind, load_month, lineage, count(*) AS n_refs, count(DISTINCT ref_id) AS n_keys FROM (SELECT *, 'direct' AS lineage FROM direct UNION ALL SELECT * REPLACE ('inherited' AS orphan_kind), 'inherited' FROM inherited) GROUP BY 1, 2, 3, 4, 5",
    "p5_found": _P5_SQL.format(columns="k AS claim_id, source_lsn"),
    "p5_state": _P5_SQL.format(columns="after_row.claim_id AS claim_id, after_row.patient_id AS patient_id, after_row.billed_amount AS billed_amount, after_row.paid_amount AS paid_amount, after_row.claim_status AS claim_status, after_row.updated_at AS updated_at, source_lsn"),
    "p6_found": _P6_SQL,
    "p6_merged_late": _P6_SQL,
}
