"""Operations: expected values, laws, and the property that an operation refuses a column or fits its derived type."""

import itertools
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilstream.functions.keyed import Kernel, Keys
from veilstream.operators import deid
from veilstream.plans import avro
from veilstream.plans import policy as P
from veilstream.plans.schema import UncoveredColumns, plan_table
from veilstream.plans.transform import clean_envelope, clean_table, required_violations

KEYS = Keys(bytes(range(32)))


def policy(rules, uncovered="halt_topic"):
    return P.parse_policy({"on_uncovered_column": uncovered, "tables": {"public.t": rules}})


def clean(spark, values, kind, rule, anchor=7, meta=None):
    df = spark.createDataFrame([(anchor, v) for v in values], f"who int, v {kind}")
    if meta:
        df = df.select("who", F.col("v").alias("v", metadata=meta))
    return [r.v for r in clean_table(df, policy({"who": {"op": "drop"}, "v": rule}), "public.t", KEYS).select("v").collect()]


ZIPS = {"02139": "021", "02139-1234": "021", "03601": "000", "0213": None, "SW1A 1AA": None, "": None, None: None, " 10001 ": "100", "abc": None}
CODES = {"E11.9": "E11", "C4A.70": "C4A", "m54.5": "M54", " I10 ": "I10", "junk": None, "": None, None: None, "1A2": None, "E1": None}
AGES = {0: "0-9", 9: "0-9", 30: "30-39", 89: "80-89", 90: "90+", 130: "90+", -1: None, None: None}


@pytest.mark.parametrize("table,kind,rule", [(ZIPS, "string", {"to": "zip3"}), (CODES, "string", {"to": "icd10_category"}), (AGES, "int", {"to": "age_band", "cap_age": 89})])
def test_expected_values(spark, table, kind, rule):
    assert clean(spark, list(table), kind, {"op": "generalize", **rule}) == list(table.values())


def test_age_band_without_cap_and_with_a_cap_inside_a_decade(spark):
    assert clean(spark, [95], "int", {"op": "generalize", "to": "age_band"}) == ["90-99"]
    assert clean(spark, [85, 86], "int", {"op": "generalize", "to": "age_band", "cap_age": 85}) == ["80-89", "86+"]


def test_code_arrays_keep_first_seen_order(spark):
    got = clean(spark, [["e11.9", None, "junk", "I10", "E11.65"], [], None], "array<string>", {"op": "generalize", "to": "icd10_category"})
    assert got == [["E11", "I10"], [], None]


def test_dates(spark):
    days = [date(1931, 5, 6), date(2000, 2, 29), None]
    assert clean(spark, days, "date", {"op": "generalize", "to": "year"}) == [1931, 2000, None]
    assert clean(spark, days, "date", {"op": "generalize", "to": "month"}) == ["1931-05", "2000-02", None]
    assert clean(spark, days, "date", {"op": "generalize", "to": "birth_year", "cap_age": 89}) == [1936, 2000, None]
    zoned = {"logical": "zoned"}
    assert clean(spark, ["2026-03-02T09:15:00Z", "last Tuesday", None], "string", {"op": "generalize", "to": "month"}, meta=zoned) == ["2026-03", None, None]


def offset(spark, anchor):
    k = Kernel(spark, KEYS)
    df = spark.createDataFrame([(anchor,)], "who int")
    from veilstream.functions.keyed import signed_draw

    d = signed_draw(k.anchor_digest("date_shift", F.col("who"), T.IntegerType()), 0, 730)
    return k.attach(df).select(d.alias("d")).first().d


def test_shift_keeps_spelling_and_intervals(spark):
    n = offset(spark, 7)
    from datetime import timedelta

    at = datetime(2026, 3, 2, 9, 15) + timedelta(days=n)
    shift = {"op": "date_shift", "anchor": "who"}
    got = clean(spark, ["2026-03-02T09:15:00Z", "2026-03-02T09:15:00.123456+00:00", "2026-03-02 09:15:00.120+0530", "last Tuesday", "", None, "2026-13-01T00:00:00Z", "2026-03-02T25:00:00Z"], "string", shift, meta={"logical": "zoned"})
    head = at.strftime("%Y-%m-%dT09:15:00")
    assert got == [head + "Z", head + ".123456+00:00", head + ".120000+05:30", None, None, None, None, None]
    assert clean(spark, [datetime(2026, 3, 2, 9, 15)], "timestamp_ntz", shift) == [at]
    assert clean(spark, [date(2026, 3, 2), None], "date", shift) == [at.date(), None]
    assert clean(spark, [None], "date", shift, anchor=None) == [None]


def test_integer_instants_shift_by_their_unit_and_saturate(spark):
    n = offset(spark, 7)
    nano = {"avro": '{"type": "long", "connect.name": "io.debezium.time.NanoTimestamp"}'}
    got = clean(spark, [0, 2**63 - 1, -(2**63)], "bigint", {"op": "date_shift", "anchor": "who"}, meta=nano)
    assert got[0] == n * 86_400_000_000_000 and got[1] in (2**63 - 1, 2**63 - 1 + n * 86_400_000_000_000) and -(2**63) <= got[2]


def test_jitter_matches_decimal_arithmetic(spark):
    rule = {"op": "numeric_jitter", "anchor": "who", "pct": 25}
    values = ["1420.00", "0.00", "-12.50", "1420", "1e400", "nan", "inf", "not money", "", " 7.5 ", "+3", ".5", "-0.01", "9" * 26 + ".99", "9" * 40, None, "0.004", "1."]
    got = clean(spark, values, "string", rule)
    factor = clean(spark, [1.0], "double", rule)[0]
    parts = Decimal(round(factor * 1_000_000)) / 1_000_000
    for v, g in zip(values, got):
        try:
            amount = Decimal(v.strip())
            plain = "e" not in v and amount.is_finite()
        except Exception:
            plain = False
        if not plain or len(v.strip("+-. ").replace(".", "")) > 28:
            assert g is None, v
        else:
            scale = max(0, -amount.as_tuple().exponent)
            try:
                want = f"{(amount * parts).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP):f}"
            except InvalidOperation:  # more than 28 digits
                want = None
            assert g == want, v
    whole = clean(spark, [100, -100, 2**63 - 1, None], "bigint", rule)
    assert whole[0] == int((100 * parts).to_integral_value(ROUND_HALF_UP)) and whole[1] == -whole[0] and whole[3] is None
    assert clean(spark, [Decimal("10.00"), None], "decimal(12,2)", rule) == [(10 * parts).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP), None]


REFUSED = [
    ("hmac", "double"), ("hmac", "date"), ("hmac", "decimal(12,2)"), ("hmac", "boolean"), ("hmac", "array<string>"), ("fake", "int"), ("zip3", "int"), ("icd10", "array<int>"), ("year", "string"), ("year", "bigint"),
    ("age_band", "double"), ("date_shift", "bigint"), ("date_shift", "string"), ("jitter", "boolean"), ("jitter", "date"), ("jitter", "timestamp"),
]
RULES = {
    "passthrough": {"op": "passthrough"}, "drop": {"op": "drop"}, "null": {"op": "null"}, "redact": {"op": "redact"}, "hmac": {"op": "hmac", "domain": "d"}, "fake": {"op": "fake", "kind": "email"},
    "zip3": {"op": "generalize", "to": "zip3"}, "icd10": {"op": "generalize", "to": "icd10_category"}, "year": {"op": "generalize", "to": "year"}, "month": {"op": "generalize", "to": "month"},
    "birth_year": {"op": "generalize", "to": "birth_year", "cap_age": 89}, "age_band": {"op": "generalize", "to": "age_band"}, "date_shift": {"op": "date_shift", "anchor": "who"}, "jitter": {"op": "numeric_jitter", "anchor": "who", "pct": 9},
}
DOMAIN = {
    "boolean": [True, False, None], "int": [0, -5, 2**31 - 1, -(2**31), None], "bigint": [0, 2**63 - 1, -(2**63), None], "float": [0.0, 1.5, None], "double": [0.0, -1.5, 1e308, None], "binary": [b"", b"\x00x", None],
    "string": ["1420.00", "", "E11.9", "02139", "junk", "日本", None], "date": [date(5, 1, 1), date(9990, 12, 31), date(2000, 2, 29), None], "timestamp": [datetime(1970, 1, 1), datetime(2026, 3, 2, 9, 15), None],
    "timestamp_ntz": [datetime(1970, 1, 1), None], "decimal(12,2)": [Decimal("0.07"), Decimal("-99.99"), None], "array<string>": [[], ["E11.9", None], None],
}


@pytest.mark.parametrize("op,kind", REFUSED)
def test_refusals_name_the_column(spark, op, kind):
    df = spark.createDataFrame([], f"who int, v {kind}")
    with pytest.raises(deid.IncompatibleColumn) as e:
        plan_table(df.schema, policy({"who": {"op": "drop"}, "v": RULES[op]}), "public.t", KEYS)
    assert "public.t.v" in str(e.value)


@pytest.mark.parametrize("op", list(RULES))
def test_every_operation_refuses_or_conforms(spark, op):
    bound = 0
    for kind, values in DOMAIN.items():
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"who int, v {kind}")
        rules = policy({"who": {"op": "passthrough"}, "v": RULES[op]})
        try:
            plan = plan_table(df.schema, rules, "public.t", KEYS)
        except deid.IncompatibleColumn:
            continue
        bound += 1
        out = clean_table(df, rules, "public.t", KEYS)
        if op == "drop":
            assert out.columns == ["who"] and not deid.DROPPED
            continue
        derived = next(b.clean for b in plan.kept if b.rule.column == "v")
        assert out.schema["v"].dataType.simpleString().replace("timestamp_ntz", "timestamp") == avro.spark_type(derived).simpleString().replace("timestamp_ntz", "timestamp")
        got = sorted(out.collect(), key=lambda r: r.who)
        again = sorted(out.collect(), key=lambda r: r.who)
        for r, s, v in zip(got, again, values):
            assert r == s
            assert v is not None or r.v is None
            assert r.v is not None or avro.is_nullable(derived)
        assert not required_violations(out)
    assert bound


def test_tokens_join_within_a_domain_only(spark):
    df = spark.createDataFrame([("  MRN-1 ",), ("mrn-1",), ("mrn-2",)], "v string")
    t = lambda d: [r.v for r in clean_table(df, policy({"v": {"op": "hmac", "domain": d}}), "public.t", KEYS).collect()]
    a, b = t("x"), t("y")
    assert a[0] == a[1] != a[2] and not set(a) & set(b) and all(len(x) == 24 for x in a)


def test_dropped_columns_are_not_read(spark, tmp_path):
    spark.range(5).select("id", F.lit("secret").alias("ssn")).write.parquet(str(tmp_path / "t"))
    out = clean_table(spark.read.parquet(str(tmp_path / "t")), policy({"id": {"op": "passthrough"}, "ssn": {"op": "drop"}}), "public.t", KEYS)
    assert "ssn" not in out._jdf.queryExecution().executedPlan().toString()


def test_uncovered_columns_halt_or_go(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, x string, y string")
    with pytest.raises(UncoveredColumns) as e:
        clean_table(df, policy({"id": {"op": "passthrough"}}), "public.t", KEYS)
    assert "x, y" in str(e.value)
    assert clean_table(df, policy({"id": {"op": "passthrough"}}, "drop_column"), "public.t", KEYS).columns == ["id"]


def test_envelopes_change_inside_only(spark):
    row = "struct<id:int,name:string,at:date>"
    df = spark.createDataFrame(
        [((1, "Ann", date(2026, 1, 1)), None, ("x", 5), "d"), (None, (2, None, None), ("y", 6), "c"), ((2, "B", None), (2, "C", None), ("z", 7), "u")], f"before {row}, after {row}, source struct<name:string,lsn:int>, op string"
    )
    rules = policy({"id": {"op": "hmac", "domain": "p"}, "name": {"op": "drop"}, "at": {"op": "date_shift", "anchor": "id"}})
    out = clean_envelope(df, rules, "public.t", KEYS).collect()
    assert [(r.source.name, r.source.lsn, r.op) for r in out] == [("x", 5, "d"), ("y", 6, "c"), ("z", 7, "u")]
    assert out[0].after is None and out[1].before is None and out[2].before.id == out[2].after.id == out[1].after.id
    assert out[0].before.asDict().keys() == {"id", "at"} and out[1].after.at is None


def test_all_pairs_are_reachable():
    assert set(deid._BUILDERS) == set(P.OPS) and len(list(itertools.product(RULES, DOMAIN))) == 168


def test_numbers_in_other_spellings_and_wide_codes(spark):
    from veilstream.operators.deid import icd10_category, jitter_text

    cases = {"1E3": "1500", "1_000": "1500", " 1_000.50 ": "1500.75", "12e-3": "0.018", "-1.5e1": "-23", "2e2": "300", ".5": "0.8", "1e99x": None, "_1": None, "nan": None, "5e-1": "0.8"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.v for r in df.select("t", jitter_text(F.col("t"), F.lit(1_500_000)).alias("v")).collect()} == cases
    codes = spark.createDataFrame([("Ｅ１１.9",), ("　ｍ54",), ("é11",)], "c string")
    assert [r[0] for r in codes.select(icd10_category(F.col("c"))).collect()] == ["E11", "M54", None]
