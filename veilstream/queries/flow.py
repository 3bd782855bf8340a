"""Queries of the streaming transform and applier, the generators and their checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..generate import churn
from ..generate.population import population, violations
from ..operators import ledger
from ..plans.policy import parse_policy
from ..session import shared_folder
from ..sources.envelopes import append_topic, envelopes
from ..streaming import applier, transform
from . import sqlkit as S
from .repair import table

POLICY = parse_policy({
    "tables": {
        "public.events": {
            "user_id": {"op": "hmac", "domain": "user"}, "event_type": {"op": "passthrough"}, "value": {"op": "numeric_jitter", "anchor": "user_id", "pct": 10},
            "seen_at": {"op": "date_shift", "anchor": "user_id"}, "props": {"op": "drop"},
        }
    }
})


def event_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "events")
    image = F.struct("user_id", "event_type", "value", F.col("ts").alias("seen_at"), "props")
    kind = F.col("event_id") % 10
    after, before = F.when(kind != 9, image), F.when(kind >= 5, image)
    op = F.when(kind == 9, "d").when(kind >= 5, "u").otherwise("c")
    return envelopes(df, "public.events", before, after, op, F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id"), F.floor(F.col("event_id") / 5))


def _cleaned(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    raw = event_envelopes(spark, folder)
    append_topic(raw, f"{home}/raw")
    schema = spark.read.parquet(f"{home}/raw").schema
    running = transform.start(spark, POLICY, {"public.events": (f"{home}/raw", schema)}, home, S.KEYS, unicode=False).finish()
    for e in running.halted.values():
        raise e
    return spark.read.parquet(f"{home}/clean/public.events"), home


def env_transform_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events as envelopes through the streaming transform, all that is there."""
    clean, _ = _cleaned(spark, folder)
    return clean.select("op", "ts_ms", "topic", "offset", F.col("source.txId").alias("tx"), F.col("before.user_id").alias("before_user"), F.col("after.user_id").alias("after_user"), "after.event_type", F.round("after.value", 6).alias("value"), "after.seen_at")


def applied_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The clean topic applied to a table by key, as a second stream."""
    clean, home = _cleaned(spark, folder)
    stream = spark.readStream.schema(clean.schema).parquet(f"{home}/clean/public.events")
    applier.start(stream, f"{home}/state", ["user_id"], f"{home}/applied").awaitTermination()
    state = applier.current(spark, f"{home}/state")
    return state.select("user_id", "event_type", "seen_at")


def timeline(spark: SparkSession) -> churn.Timeline:
    """Two thousand transactions on the whole population."""
    return churn.plan(transactions=2000, start=churn.start_rows(population(spark)))


def churn_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Replay of a generated timeline against the planner's own state: no row may differ."""
    planned = timeline(spark)
    return ledger.difference(ledger.replay(churn.ledger(spark, planned), ["table_name", "row_id"], ["after_row"]), churn.state(spark, planned))


def churn_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.summary(churn.ledger(spark, timeline(spark))).select("table_name", "op", "n_entries", "n_transactions")


def churn_report(spark: SparkSession, folder: str) -> DataFrame:
    return churn.report(spark, timeline(spark))


def churn_checks(spark: SparkSession, folder: str) -> DataFrame:
    return churn.violations(spark, timeline(spark))


def population_checks(spark: SparkSession, folder: str) -> DataFrame:
    return violations(population(spark))


def population_counts(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for name, df in population(spark).items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def ssn_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Spellings of the patients' social security numbers."""
    form = F.regexp_replace(F.upper(F.trim("ssn")), r"\d", "9").alias("form")
    return table(spark, folder, "patients").where("ssn IS NOT NULL").groupBy(form).agg(F.count(F.lit(1)).alias("n_rows"))


def visit_states(spark: SparkSession, folder: str) -> DataFrame:
    """Which instants visits of each status have."""
    df = table(spark, folder, "appointments")
    return df.groupBy("status", F.col("checked_in_at").isNotNull().alias("arrived"), F.col("completed_at").isNotNull().alias("ended")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("appointment_id").alias("n_visits"))


_POPULATION_CHECKS = (
    "providers_count patients_count appointments_count claims_count notes_count null_emails null_ssns leading_zero_zips over_89 odd_names_missing ssn_forms_missing phone_forms_missing mrn_repeated status_and_arrival"
    " status_and_end ends_before_arrival instants_shared judged_without_parts parts_do_not_add_up denied_but_paid allowed_more_than_billed empty_codes amounts_missing claims_of_other_patients notes_of_other_patients"
    " amended_notes_of_other_patients amended_flags"
)
_CHURN_CHECKS = "shapes_missing transactions_with_two_instants instants_not_rising claims_without_visit notes_without_visit rows_without_patient amended_without_flag status_and_arrival beyond_ceilings"


def _zeros(names: str) -> str:
    return 'SELECT unnest([' + ", ".join(f"'{n}'" for n in names.split()) + ']) AS "check", 0::BIGINT AS n_bad'


_D = S.digest("hmac:user", "user_id::VARCHAR")
_SHIFT, _JIT = S.signed(S.digest("date_shift", "user_id::VARCHAR"), 730), S.signed(S.digest("numeric_jitter", "user_id::VARCHAR"), 10_000)
QUERIES = {
    "env_transform_stream": env_transform_stream, "applied_stream": applied_stream, "churn_replay": churn_replay, "churn_summary": churn_summary, "population_counts": population_counts,
    "churn_report": churn_report, "churn_checks": churn_checks, "population_checks": population_checks, "ssn_forms": ssn_forms, "visit_states": visit_states,
}
SQL = {
    "env_transform_stream": f"SELECT CASE WHEN k = 9 THEN 'd' WHEN k >= 5 THEN 'u' ELSE 'c' END AS op, epoch_us(ts) // 1000 AS ts_ms, 'clean.public.events' AS topic, event_id AS \"offset\", event_id // 5 AS tx, CASE WHEN k >= 5 THEN {S.token('d')} END AS before_user,"
    f" CASE WHEN k <> 9 THEN {S.token('d')} END AS after_user, CASE WHEN k <> 9 THEN event_type END AS event_type, CASE WHEN k <> 9 THEN round(value * ((1000000 + 10 * j) / 1000000.0::DOUBLE), 6) END AS value, CASE WHEN k <> 9 THEN ts + to_days(s::INT) END AS seen_at"
    f" FROM (SELECT *, event_id % 10 AS k, {_D} AS d, {_SHIFT} AS s, {_JIT} AS j FROM events)",
    "applied_stream": f"SELECT {S.token('d')} AS user_id, event_type, ts + to_days(s::INT) AS seen_at FROM (SELECT *, {_D} AS d, {_SHIFT} AS s, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_id % 10 <> 9",
    "churn_replay": "SELECT '' AS table_name, 0::BIGINT AS row_id, '' AS after_row, '' AS side WHERE false",
    "churn_checks": _zeros(_CHURN_CHECKS),
    "population_checks": _zeros(_POPULATION_CHECKS),
    "ssn_forms": r"SELECT regexp_replace(upper(trim(ssn)), '\d', '9', 'g') AS form, count(*) AS n_rows FROM patients WHERE ssn IS NOT NULL GROUP BY 1",
    "visit_states": "SELECT status, checked_in_at IS NOT NULL AS arrived, completed_at IS NOT NULL AS ended, count(*) AS n_rows, count(DISTINCT appointment_id) AS n_visits FROM appointments GROUP BY 1, 2, 3",
    "population_counts": "SELECT * FROM (VALUES ('providers', 12::BIGINT), ('patients', 250), ('appointments', 900), ('claims', 500), ('notes', 750)) t(table_name, n_rows)",
}
