"""Queries of the de-identification operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.policy import Policy, parse_policy
from ..plans.transform import clean_table
from . import sqlkit as S
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


def zoned(df: DataFrame, *columns: str) -> DataFrame:
    """Declares string columns to hold zoned instants."""
    return df.select(*[F.col(c).alias(c, metadata={"logical": "zoned"}) if c in columns else F.col(c) for c in df.columns])


def policy_of(rules: dict[str, dict], name: str = "public.t", uncovered: str = "halt_topic") -> Policy:
    return parse_policy({"on_uncovered_column": uncovered, "tables": {name: rules}})


def cleaned(df: DataFrame, rules: dict[str, dict], unicode: bool = False, uncovered: str = "halt_topic") -> DataFrame:
    return clean_table(df, policy_of(rules, uncovered=uncovered), "public.t", S.KEYS, unicode)


# --- hmac -------------------------------------------------------------------------------------------


@query(f"SELECT {S.token('h')} AS c_custkey, {S.token('n')} AS c_name, c_nationkey FROM (SELECT *, {S.digest('hmac:customer', 'c_custkey::VARCHAR')} AS h, {S.digest('hmac:name', S.canonical('c_name'))} AS n FROM customer)")
def hmac_tokens_customer(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    return cleaned(df, {"c_custkey": {"op": "hmac", "domain": "customer"}, "c_name": {"op": "hmac", "domain": "name"}, "c_nationkey": {"op": "passthrough"}})


@query("SELECT 0::BIGINT AS n_joined, (SELECT count(DISTINCT c_custkey) FROM customer) AS n_same_domain")
def hmac_domain_separation(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two domains never join; tokens of one always do."""
    df = table(spark, folder, "customer").select("c_custkey")
    token = lambda d: cleaned(df, {"c_custkey": {"op": "hmac", "domain": d}})
    apart = token("customer").join(token("supplier"), "c_custkey").agg(F.count(F.lit(1)).alias("n_joined"))
    return apart.withColumn("n_same_domain", token("customer").join(token("customer"), "c_custkey", "left_semi").agg(F.count_distinct("c_custkey").alias("n")).scalar())


_SHIFT = S.signed(S.digest("date_shift", "o_custkey::VARCHAR"), 730)
_JITTER = S.signed(S.digest("numeric_jitter", "o_custkey::VARCHAR"), 10_000)


@query(
    f"SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice * ((1000000 + 5 * {_JITTER}) / 1000000.0::DOUBLE)), 2) AS revenue"
    " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"
)
def token_join_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Clean tables joined on tokens: jittered revenue per market segment."""
    customers = cleaned(
        table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        {"c_custkey": {"op": "hmac", "domain": "customer"}, "c_name": {"op": "fake", "kind": "full_name"}, "c_mktsegment": {"op": "passthrough"}},
    )
    orders = cleaned(
        table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice"),
        {"o_custkey": {"op": "hmac", "domain": "customer"}, "o_orderdate": {"op": "date_shift", "anchor": "o_custkey"}, "o_totalprice": {"op": "numeric_jitter", "anchor": "o_custkey", "pct": 5}},
    )
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("SELECT '[redacted]' AS s_name, NULL::INT AS s_nationkey, s_suppkey FROM supplier")
def redact_null_drop_projection(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(table(spark, folder, "supplier"), {"s_suppkey": {"op": "passthrough"}, "s_name": {"op": "redact"}, "s_nationkey": {"op": "null"}, "s_acctbal": {"op": "drop"}})


@query("SELECT s_suppkey, s_name FROM supplier")
def uncovered_drop_column(spark: SparkSession, folder: str) -> DataFrame:
    """Columns without a rule are left out where the policy says so."""
    return cleaned(table(spark, folder, "supplier"), {"s_suppkey": {"op": "passthrough"}, "s_name": {"op": "passthrough"}}, uncovered="drop_column")


def _fake(kind: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return cleaned(table(spark, folder, "customer").select("c_custkey", "c_name"), {"c_custkey": {"op": "passthrough"}, "c_name": {"op": "fake", "kind": kind}})

    run.__name__ = f"fake_{kind}"
    return query(f"SELECT c_custkey, {S.synthetic(kind, 'h')} AS c_name FROM (SELECT c_custkey, {S.digest('fake:' + kind, S.canonical('c_name'))} AS h FROM customer)")(run)


for _kind in ("first_name", "middle_name", "last_name", "full_name", "email", "phone", "street_address", "city", "postal_code", "company"):
    _fake(_kind)


# --- generalisation ------------------------------------------------------------------------------------


@query(f"SELECT c_custkey, {S.zip3('z')} AS zip FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'SW1A 1AA' WHEN c_custkey % 7 = 0 THEN (c_custkey % 1000)::VARCHAR ELSE lpad((c_custkey * 7919 % 100000)::VARCHAR, 5, '0') || '-12' END AS z FROM customer)")
def zip3_generalize(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    code = F.when(key % 11 == 0, F.lit("SW1A 1AA")).when(key % 7 == 0, (key % 1000).cast("string")).otherwise(F.concat(F.lpad((key * 7919 % 100000).cast("string"), 5, "0"), F.lit("-12")))
    return cleaned(table(spark, folder, "customer").select("c_custkey", code.alias("zip")), {"c_custkey": {"op": "passthrough"}, "zip": {"op": "generalize", "to": "zip3"}})


_CODE = "CASE WHEN p_partkey % 13 = 0 THEN 'junk' WHEN p_partkey % 5 = 0 THEN NULL ELSE ' ' || chr(97 + (p_partkey % 26)::INT) || lpad((p_partkey % 100)::VARCHAR, 2, '0') || '.' || (p_partkey % 10)::VARCHAR END"


def _code(key):
    letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (key % 26 + 1).cast("int"), F.lit(1))
    return F.when(key % 13 == 0, F.lit("junk")).when(key % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), letter, F.lpad((key % 100).cast("string"), 2, "0"), F.lit("."), (key % 10).cast("string")))


@query(f"SELECT p_partkey, {S.icd10('c')} AS code FROM (SELECT p_partkey, {_CODE} AS c FROM part)")
def icd10_scalar(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", _code(F.col("p_partkey")).alias("code"))
    return cleaned(df, {"p_partkey": {"op": "passthrough"}, "code": {"op": "generalize", "to": "icd10_category"}})


@query(
    f"SELECT p_partkey, list_filter(list_transform(range(len(g)), lambda i: CASE WHEN list_position(g, g[i + 1]) = i + 1 THEN g[i + 1] END), lambda x: x IS NOT NULL) AS codes FROM (SELECT p_partkey, list_transform([{_CODE}, 'E11.9', ' e11.65', {_CODE}, 'C4A.70'], lambda x: {S.icd10('x')}) AS g FROM part)"
)
def icd10_array(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    df = table(spark, folder, "part").select("p_partkey", F.array(_code(key), F.lit("E11.9"), F.lit(" e11.65"), _code(key), F.lit("C4A.70")).alias("codes"))
    return cleaned(df, {"p_partkey": {"op": "passthrough"}, "codes": {"op": "generalize", "to": "icd10_category"}})


@query("SELECT year(o_orderdate)::INT AS y, strftime(o_orderdate, '%Y-%m') AS m, count(*) AS n FROM orders GROUP BY 1, 2")
def year_month_generalize(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").select(F.col("o_orderdate").alias("y"), F.col("o_orderdate").alias("m"))
    return cleaned(df, {"y": {"op": "generalize", "to": "year"}, "m": {"op": "generalize", "to": "month"}}).groupBy("y", "m").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, greatest(year(o_orderdate), 2026 - 30 - 1)::INT AS born FROM orders")
def birth_year_cap(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("born"))
    return cleaned(df, {"o_orderkey": {"op": "passthrough"}, "born": {"op": "generalize", "to": "birth_year", "cap_age": 30}})


@query(f"SELECT p_partkey, {S.age_band('(p_size - 1)', 39)} AS age FROM part")
def age_band_int(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", (F.col("p_size") - 1).alias("age"))
    return cleaned(df, {"p_partkey": {"op": "passthrough"}, "age": {"op": "generalize", "to": "age_band", "cap_age": 39}})


@query(f"SELECT o_orderkey, {S.age_band('(2026 - year(o_orderdate))', 85)} AS band FROM orders")
def age_band_date(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("band"))
    return cleaned(df, {"o_orderkey": {"op": "passthrough"}, "band": {"op": "generalize", "to": "age_band", "cap_age": 85}})


# --- shifts and jitter -----------------------------------------------------------------------------------


@query(f"SELECT o_orderkey, o_orderdate + to_days({_SHIFT}::INT) AS o_orderdate FROM orders")
def date_shift_orders(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return cleaned(df, {"o_orderkey": {"op": "passthrough"}, "o_custkey": {"op": "drop"}, "o_orderdate": {"op": "date_shift", "anchor": "o_custkey"}})


@query("SELECT count(*) AS n_pairs, 0::BIGINT AS n_changed FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def interval_preservation(spark: SparkSession, folder: str) -> DataFrame:
    """Days between two dates of one entity are the same after the shift."""
    pairs = table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate").join(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = pairs.select("o_custkey", "o_orderdate", "l_shipdate", F.datediff("l_shipdate", "o_orderdate").alias("days"))
    shift = {"op": "date_shift", "anchor": "o_custkey"}
    moved = cleaned(pairs, {"o_custkey": {"op": "hmac", "domain": "customer"}, "o_orderdate": shift, "l_shipdate": shift, "days": {"op": "passthrough"}})
    return moved.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.datediff("l_shipdate", "o_orderdate") != F.col("days")).alias("n_changed"))


@query(f"SELECT o_orderkey, round(o_totalprice * ((1000000 + 5 * {_JITTER}) / 1000000.0::DOUBLE), 4) AS o_totalprice FROM orders")
def jitter_totalprice(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = cleaned(df, {"o_orderkey": {"op": "passthrough"}, "o_custkey": {"op": "drop"}, "o_totalprice": {"op": "numeric_jitter", "anchor": "o_custkey", "pct": 5}})
    return out.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("SELECT count(*) AS n_rows, 0::BIGINT AS n_reordered FROM lineitem")
def jitter_ratio_preserved(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts of one entity keep their order, as they share a factor."""
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("paid"))
    jitter = {"op": "numeric_jitter", "anchor": "l_orderkey", "pct": 25}
    out = cleaned(df, {"l_orderkey": {"op": "hmac", "domain": "order"}, "l_extendedprice": jitter, "paid": jitter})
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("paid") > F.col("l_extendedprice")).alias("n_reordered"))


_CENTS = "(round(o_totalprice * 100)::BIGINT)"
_MOVED = f"((({_CENTS})::HUGEINT * (1000000 + 10 * {_JITTER}) * 2 + 1000000) // 2000000)"


@query(f"SELECT o_orderkey, (m // 100)::VARCHAR || '.' || lpad((m % 100)::VARCHAR, 2, '0') AS amount FROM (SELECT o_orderkey, {_MOVED} AS m FROM orders)")
def jitter_text_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts that are strings keep their two places."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    amount = F.concat((F.floor(cents / 100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    df = table(spark, folder, "orders").select("o_orderkey", "o_custkey", amount.alias("amount"))
    return cleaned(df, {"o_orderkey": {"op": "passthrough"}, "o_custkey": {"op": "drop"}, "amount": {"op": "numeric_jitter", "anchor": "o_custkey", "pct": 10}})


@query(f"SELECT p_partkey, (((p_size * 1000)::HUGEINT * (1000000 + 20 * {S.signed(S.digest('numeric_jitter', 'p_partkey::VARCHAR'), 10_000)}) * 2 + 1000000) // 2000000)::INT AS units FROM part")
def jitter_whole_numbers(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", (F.col("p_size") * 1000).alias("units"))
    return cleaned(df, {"p_partkey": {"op": "passthrough"}, "units": {"op": "numeric_jitter", "anchor": "p_partkey", "pct": 20}})


# --- the clinic's tables under their whole policy ---------------------------------------------------------

_STAMPS = lambda anchor, *columns: {c: {"op": "date_shift", "anchor": anchor} for c in columns}
_KEY = lambda domain: {"op": "hmac", "domain": domain}
_KEEP, _DROP = {"op": "passthrough"}, {"op": "drop"}
_PAID = ("billed_amount", "allowed_amount", "paid_amount", "patient_responsibility")

# The rule of each column of the clinic.
CLINIC_POLICY = {
    "on_uncovered_column": "drop_column",
    "tables": {
        "public.patients": {
            "patient_id": _KEY("patient"), "mrn": _KEY("mrn"), "first_name": {"op": "fake", "kind": "first_name"}, "middle_name": {"op": "fake", "kind": "middle_name"},
            "last_name": {"op": "fake", "kind": "last_name"}, "date_of_birth": {"op": "generalize", "to": "birth_year", "cap_age": 89}, "ssn": _DROP, "email": {"op": "fake", "kind": "email"},
            "phone": {"op": "fake", "kind": "phone"}, "address_line1": _DROP, "address_line2": _DROP, "city": _DROP, "state": _KEEP, "postal_code": {"op": "generalize", "to": "zip3"},
            **_STAMPS("patient_id", "created_at", "updated_at"),
        },
        "public.providers": {
            "provider_id": _KEY("provider"), "npi": _KEY("npi"), "full_name": {"op": "fake", "kind": "full_name"}, "specialty": _KEEP, "email": {"op": "fake", "kind": "email"},
            **_STAMPS("provider_id", "created_at", "updated_at"),
        },
        "public.appointments": {
            "appointment_id": _KEY("appointment"), "patient_id": _KEY("patient"), "provider_id": _KEY("provider"), "duration_minutes": _KEEP, "status": _KEEP, "location_name": _DROP,
            "intake_answers": _DROP, **_STAMPS("patient_id", "scheduled_at", "checked_in_at", "completed_at", "created_at", "updated_at"),
        },
        "public.claims": {
            "claim_id": _KEY("claim"), "patient_id": _KEY("patient"), "appointment_id": _KEY("appointment"), **{c: _KEEP for c in _PAID}, "diagnosis_codes": {"op": "generalize", "to": "icd10_category"},
            "procedure_code": _KEEP, "claim_status": _KEEP, **_STAMPS("patient_id", "submitted_at", "adjudicated_at", "created_at", "updated_at"),
        },
        "public.notes": {
            "note_id": _KEY("note"), "patient_id": _KEY("patient"), "provider_id": _KEY("provider"), "appointment_id": _KEY("appointment"), "amends_note_id": _KEY("note"), "note_type": _KEEP,
            "body": _DROP, "is_amended": _KEEP, **_STAMPS("patient_id", "authored_at", "signed_at", "created_at", "updated_at"),
        },
    },
}


def _clinic_sql(name: str) -> str:
    rules = CLINIC_POLICY["tables"][f"public.{name}"]
    out, digests = [], {}
    for c, r in rules.items():
        if r["op"] == "hmac":
            digests[f"d_{c}"] = S.digest("hmac:" + r["domain"], S.canonical(c) if c in ("mrn", "npi") else f"{c}::VARCHAR")
            out.append(f"CASE WHEN {c} IS NOT NULL THEN {S.token(f'd_{c}')} END AS {c}")
        elif r["op"] == "fake":
            digests[f"d_{c}"] = S.digest("fake:" + r["kind"], S.canonical(c))
            out.append(f"CASE WHEN {c} IS NOT NULL THEN {S.synthetic(r['kind'], f'd_{c}')} END AS {c}")
        elif r["op"] == "date_shift":
            a = r["anchor"]
            digests[f"s_{a}"] = S.digest("date_shift", f"{a}::VARCHAR")
            out.append(f"{S.shift_zoned(c, S.signed(f's_{a}', 730))} AS {c}")
        elif r["op"] == "generalize":
            made = {"zip3": S.zip3(c), "birth_year": f"greatest(year({c}), 1936)::INT"}
            codes = f"list_transform({c}, lambda x: {S.icd10('x')})"
            made["icd10_category"] = f"CASE WHEN {c} IS NOT NULL THEN list_filter(list_transform(range(len({codes})), lambda i: CASE WHEN list_position({codes}, ({codes})[i + 1]) = i + 1 THEN ({codes})[i + 1] END), lambda x: x IS NOT NULL) END"
            out.append(f"{made[r['to']]} AS {c}")
        elif r["op"] == "passthrough":
            out.append(c)
    return f"SELECT {', '.join(out)} FROM (SELECT *, {', '.join(f'{e} AS {n}' for n, e in digests.items())} FROM {name})"


def _clinic(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        policy = parse_policy(CLINIC_POLICY)
        stamps = [c for c, r in CLINIC_POLICY["tables"][f"public.{name}"].items() if r["op"] == "date_shift"]
        return clean_table(zoned(table(spark, folder, name), *stamps), policy, f"public.{name}", S.KEYS)

    run.__name__ = f"clean_{name}"
    return query(_clinic_sql(name))(run)


for _name in ("patients", "providers", "appointments", "claims", "notes"):
    _clinic(_name)
