"""Replay, checks, cuts, cascades, fingerprints, apportionment, generators, streaming."""

import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from veilstream.functions.keyed import Keys
from veilstream.generate import churn
from veilstream.generate.population import ODD_NAMES, Size, population, violations
from veilstream.operators import apportion, cascade, fingerprint, identify, ledger
from veilstream.plans.policy import parse_policy
from veilstream.sources.envelopes import append_topic, envelope_schema, envelopes, missing_before_images
from veilstream.streaming import applier, transform

T0 = datetime(2026, 1, 1)


def at(n):
    return T0 + timedelta(seconds=n)


@pytest.fixture(scope="module")
def log(spark):
    rows = [(1, 1, at(1), "I", "a", 1), (2, 1, at(1), "I", "b", 1), (3, 2, at(2), "U", "a", 2), (4, 3, at(3), "D", "b", None), (5, 4, at(4), "I", "b", 9), (6, 5, at(5), "D", "c", None), (7, 6, None, "I", "d", 1), (8, 7, at(6), "I", None, 4)]
    return spark.createDataFrame(rows, "history_id bigint, txid bigint, tx_at timestamp, op string, k string, v int")


@pytest.mark.parametrize("when,want", [(0, {}), (1, {"a": 1, "b": 1}), (2, {"a": 2, "b": 1}), (3, {"a": 2}), (4, {"a": 2, "b": 9}), (None, {"a": 2, "b": 9, None: 4})])
def test_replay(log, when, want):
    got = ledger.replay(log, ["k"], ["v"], None if when is None else at(when))
    assert {r.k: r.v for r in got.collect()} == want


def test_difference_and_checks(spark, log):
    state = ledger.replay(log, ["k"], ["v"])
    assert ledger.difference(state, state).count() == 0
    assert {(r.k, r.side) for r in ledger.difference(state, state.where("k = 'a'").union(state.where("k = 'a'"))).collect()} == {("b", "ledger"), (None, "ledger"), ("a", "live")}
    bent = log.withColumn("tx_at", F.when(F.col("history_id") == 2, F.lit(at(0))).otherwise(F.col("tx_at")))
    assert [r.history_id for r in ledger.inversions(bent, stretch=1).collect()] == [2] and ledger.inversions(log.where("tx_at IS NOT NULL")).count() == 0
    assert [r.txid for r in ledger.split_transactions(bent).collect()] == [1]
    with pytest.raises(ledger.OutsideWindow):
        ledger.guard(at(0), at(1))
    ledger.guard(at(1), at(1))


def test_cuts_see_none_or_all_of_a_transaction(spark):
    rows = [("x", 0, 0, 1000, 1), ("x", 0, 1, 1001, 2), ("y", 0, 0, 1001, 2), ("x", 0, 2, 1001, 3), ("y", 0, 1, 1002, 3), ("y", 0, 2, 1002, None)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ts_ms bigint, txid bigint")
    cut = lambda t: {(r.topic): r.cut_offset for r in ledger.manifest(log, t).collect()}
    assert cut(999) == {"x": 0, "y": 0} and cut(1000) == {"x": 1, "y": 0} and cut(1001) == {"x": 3, "y": 1} and cut(1002) == {"x": 3, "y": 3}
    snap = lambda t: sorted((r.topic, r.offset) for r in ledger.snap_to_transactions(log, ledger.manifest(log, t)).collect())
    assert snap(1000) == [("x", 0)] and snap(1001) == [("x", 0), ("x", 1), ("y", 0)] and len(snap(1002)) == 6
    assert ledger.inside(log, ledger.manifest(log, 1001)).count() == 4


def clinic(spark):
    return {
        "patients": spark.createDataFrame([(1,), (2,)], "patient_id bigint"), "providers": spark.createDataFrame([(5,), (6,)], "provider_id bigint"),
        "appointments": spark.createDataFrame([(10, 1, 5), (11, 2, 5)], "appointment_id bigint, patient_id bigint, provider_id bigint"), "claims": spark.createDataFrame([(20, 1, 10), (21, 2, 10), (22, 2, None)], "claim_id bigint, patient_id bigint, appointment_id bigint"),
        "notes": spark.createDataFrame([(30, 1, 5, 10, None), (31, 2, 5, 10, 30), (32, 2, 5, 11, 31)], "note_id bigint, patient_id bigint, provider_id bigint, appointment_id bigint, amends_note_id bigint"),
    }


def test_cascade(spark):
    deletes = lambda *x: spark.createDataFrame(list(x), "table_name string, row_id bigint")
    got = {(r.table_name, r.row_id, r.op, r.field, r.depth) for r in cascade.consequences(clinic(spark), cascade.CLINIC, deletes(("patients", 1), ("patients", 1), ("patients", 99))).collect()}
    assert got == {("patients", 1, "D", "", 0), ("appointments", 10, "D", "", 1), ("claims", 20, "D", "", 1), ("notes", 30, "D", "", 1), ("claims", 21, "D", "", 2), ("notes", 31, "U", "appointment_id", 2), ("notes", 31, "U", "amends_note_id", 2)}
    assert cascade.consequences(clinic(spark), cascade.CLINIC, deletes(("providers", 6))).count() == 1
    with pytest.raises(cascade.RestrictedDelete):
        cascade.consequences(clinic(spark), cascade.CLINIC, deletes(("providers", 5)))
    assert cascade.consequences(clinic(spark), cascade.CLINIC, deletes(("patients", 99))).count() == 0


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a", Decimal("1.50"), date(2026, 1, 1), ["x"], None), (2, None, None, None, [], {"b": 1, "a": 2})], "id int, s string, d decimal(9,4), day date, xs array<string>, m map<string,int>")
    one = fingerprint.fingerprint(df).first()
    assert one.n_rows == 2 and fingerprint.fingerprint(df.orderBy(F.desc("id")).repartition(3).select(*reversed(df.columns))).first() == one
    assert fingerprint.fingerprint(df.union(df)).first().digest != one.digest
    assert fingerprint.fingerprint(df.withColumn("s", F.coalesce("s", F.lit("")))).first().digest != one.digest
    assert fingerprint.fingerprint(df.limit(0)).first().n_rows == 0
    swapped = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert len({r.h for r in swapped.select(fingerprint.row_hash(swapped).alias("h")).collect()}) == 2


def test_apportion(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)] + [(99, None), (98, -5.0)], "k int, w double")
    for total in (0, 1, 137):
        got = {r.k: r.share for r in apportion.largest_remainder(df, "k", F.col("w"), total).collect()}
        assert sum(got.values()) == total and got[99] == 0 == got[98]
        whole = sum(i % 7 for i in range(50))
        assert all(abs(got[i] - (i % 7) * total / whole) < 1 for i in range(50))
    even = spark.createDataFrame([(i, 0.0) for i in range(3)], "k int, w double")
    assert [r.share for r in apportion.largest_remainder(even, "k", F.col("w"), 7).orderBy("k").collect()] == [3, 2, 2]
    assert apportion.largest_remainder(even.limit(0), "k", F.col("w"), 7).count() == 0


def test_spread_instants(spark):
    df = spark.createDataFrame([(i, "g", T0 + timedelta(microseconds=[0, 0, 1, 1, 9][i])) for i in range(5)] + [(7, "h", T0), (8, "h", None)], "i int, g string, t timestamp")
    got = {r.i: r.t for r in apportion.spread_instants(df, ["g"], "t", "i").collect()}
    assert [(got[i] - T0).microseconds for i in range(5)] == [0, 1, 2, 3, 9] and got[7] == T0 and got[8] is None


def test_population(spark):
    people = population(spark, 3)
    size = Size()
    assert {k: d.count() for k, d in people.items()} == {k: getattr(size, k) for k in people}
    p = people["patients"]
    assert p.where("email IS NULL").count() == 8 and p.where("ssn IS NULL").count() == 10 and p.where("date_of_birth < '1936-01-01'").count() == 3 and p.where("postal_code LIKE '0%'").count() == 4
    assert p.where(F.col("first_name").isin(ODD_NAMES)).count() >= 6
    claims = people["claims"]
    assert claims.where(F.size("diagnosis_codes") == 0).count() == 3 and claims.where("billed_amount = 99999999.99").count() == 1
    visits = people["appointments"]
    assert visits.groupBy("patient_id", "scheduled_at").count().where("count > 1").count() == 0
    assert claims.join(visits.select("appointment_id", F.col("patient_id").alias("p")), "appointment_id").where("p <> patient_id").count() == 0
    assert people["appointments"].select("patient_id").distinct().count() < 250
    again = fingerprint.fingerprint(population(spark, 3)["notes"].repartition(5)).first()
    assert again == fingerprint.fingerprint(people["notes"]).first() != fingerprint.fingerprint(population(spark, 4)["notes"]).first()
    for r in people["providers"].collect():
        digits = [int(c) for c in "80840" + r.npi][::-1]
        assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_population_checks(spark):
    assert all(r.n_bad == 0 for r in violations(population(spark, 3)).collect())
    bent = population(spark, 3)
    bent["notes"] = bent["notes"].withColumn("is_amended", F.lit(False))
    bent["claims"] = bent["claims"].withColumn("paid_amount", F.col("paid_amount") + 1).limit(400)
    found = {r.check for r in violations(bent).collect() if r.n_bad}
    assert {"amended_flags", "parts_do_not_add_up", "denied_but_paid", "claims_count"} <= found


def test_churn_is_its_own_oracle(spark):
    one = churn.plan(seed=5, transactions=300)
    entries, rows = one.entries, one.rows
    assert entries == churn.plan(seed=5, transactions=300).entries != churn.plan(seed=6, transactions=300).entries
    log, state = churn.ledger(spark, one), churn.state(spark, one)
    assert ledger.difference(ledger.replay(log, ["table_name", "row_id"], ["after_row"]), state).count() == 0
    assert ledger.inversions(log).count() == 0 and ledger.split_transactions(log).count() == 0 and ledger.wide_transactions(log).count() > 0 and ledger.shared_instants(log).count() == 0
    assert {e[5] for e in entries} == {"I", "U", "D"} and one.stopped == "done" and all(r.n_bad == 0 for r in churn.violations(spark, one).collect() if r.check != "shapes_missing")
    assert sum(one.cascaded.values()) == sum(r.n for r in churn.report(spark, one).where("counter = 'cascaded'").collect()) > 0
    short = churn.plan(seed=1, transactions=500, limits=churn.Ceilings(entries=200))
    assert len(short.entries) < 260 and short.stopped == "entries"
    assert churn.plan(seed=1, transactions=50, limits=churn.Ceilings(transactions=20)).stopped == "transactions" and churn.plan(seed=1, transactions=500, limits=churn.Ceilings(seconds=60), rate=4).stopped == "seconds"


def test_churn_on_the_population(spark):
    one = churn.plan(transactions=400, start=churn.start_rows(population(spark)))
    size = Size()
    assert all(0.65 * getattr(size, t) <= len(one.rows[t]) <= 1.45 * getattr(size, t) for t in churn.Clinic.TABLES)
    assert [e[5] for e in one.entries[:2412]] == ["I"] * 2412 and {"ssn", "phone", "address_line1"} <= json.loads(one.entries[12][8]).keys()


def test_streams(spark, tmp_path):
    image = F.struct("k", "v")
    df = spark.createDataFrame([(1, "a", 1, "c"), (2, "b", 2, "c"), (3, "a", 3, "u"), (4, "b", None, "d")], "n bigint, k string, v int, op string")
    raw = envelopes(df, "public.t", F.when(F.col("op") != "c", image), F.when(F.col("op") != "d", image), F.col("op"), F.col("n") * 1000, F.col("n"), F.col("n"))
    assert missing_before_images(raw).count() == 0
    append_topic(raw, str(tmp_path / "raw"))
    schema = spark.read.parquet(str(tmp_path / "raw")).schema
    assert [f.name for f in envelope_schema(df.schema).fields][:5] == [f.name for f in schema.fields][:5]
    policy = parse_policy({"tables": {"public.t": {"k": {"op": "hmac", "domain": "k"}, "v": {"op": "passthrough"}}, "public.u": {"k": {"op": "drop"}}}})
    keys = Keys(bytes(16))
    topics = {"public.t": (str(tmp_path / "raw"), schema), "public.u": (str(tmp_path / "raw"), schema)}
    running = transform.start(spark, policy, topics, str(tmp_path / "out"), keys).finish()
    assert list(running.halted) == ["public.u"] and list(running.queries) == ["public.t"]
    clean = spark.read.parquet(str(tmp_path / "out/clean/public.t"))
    batch = transform.clean_envelope(spark.read.parquet(str(tmp_path / "raw")), policy, "public.t", keys)
    assert sorted(map(str, clean.drop("topic").collect())) == sorted(map(str, batch.drop("topic").collect())) and {r.topic for r in clean.collect()} == {"clean.public.t"}
    assert {r.source.lsn for r in clean.collect()} == {1, 2, 3, 4}
    go = lambda: applier.start(spark.readStream.schema(clean.schema).parquet(str(tmp_path / "out/clean/public.t")), str(tmp_path / "state"), ["k"], str(tmp_path / "applied")).awaitTermination()
    assert applier.current(spark, str(tmp_path / "state")) is None
    go()
    assert [r.v for r in applier.current(spark, str(tmp_path / "state")).collect()] == [3]
    more = envelopes(spark.createDataFrame([(5, "c", 5, "c")], df.schema), "public.t", F.when(F.col("op") != "c", image), image, F.col("op"), F.col("n") * 1000, F.col("n"), F.col("n"))
    append_topic(more, str(tmp_path / "raw"))
    transform.start(spark, policy, {"public.t": topics["public.t"]}, str(tmp_path / "out"), keys).finish()
    go()
    assert sorted(r.v for r in applier.current(spark, str(tmp_path / "state")).collect()) == [3, 5]


def test_hot_groups_and_ties(spark):
    """A group, a parent and a class of equal remainders with a third of all rows or more, against plain windows and joins."""
    n = 6000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("g"), F.timestamp_micros(F.floor(F.col("id") / 7) * (1 << 33)).alias("at"))
    got = {r.id: r.at for r in apportion.spread_instants(df, ["g"], "at", "id", 1 << 32).collect()}
    want, last = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.at, r.id)):
        at = r.at if r.g not in last else max(r.at, last[r.g] + timedelta(microseconds=1 << 32))
        want[r.id] = last[r.g] = at
    assert got == want
    even = apportion.largest_remainder(df, "id", F.lit(1), n // 2)
    assert {r.id for r in even.where("share = 1").collect()} == set(range(n // 2))
    kids = df.select(F.col("id").alias("k"), F.col("g").alias("p"))
    parents = spark.range(60).select(F.col("id").alias("p_id"), F.concat(F.lit("n"), "id").alias("name"))
    named = fingerprint.natural(kids, [("p", parents.unionByName(parents.withColumn("name", F.lit("zz"))), "p_id", F.col("name"), "parent")])
    assert named.count() == n and named.where("parent = 'n0'").count() == n // 3
    doomed = spark.createDataFrame([("parents", 0)], "table_name string, row_id bigint")
    refs = (cascade.Reference("kids", "k", "p", "parents", cascade.CASCADE),)
    gone = cascade.consequences({"parents": parents.select("p_id"), "kids": kids}, refs, doomed, hot_rows=500)
    assert gone.where("table_name = 'kids'").count() == n // 3


def test_exact_rank(spark):
    df = spark.range(101).select(((F.col("id") * 37) % 101).alias("v"))
    assert identify.at_rank(df, "v", 0.5) == 50 and identify.at_rank(df, "v", 0) == 0 and identify.at_rank(df.limit(0), "v", 0.5) is None


def test_applier_compacts(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "op string, after struct<k int, v int>, before struct<k int, v int>, source struct<lsn bigint>, offset bigint"
    for n, rows in enumerate([[("c", (1, 1), None, (1,), 1), ("c", (2, 2), None, (2,), 2)], [("d", None, (1, 1), (5,), 3)], [("u", (1, 9), None, (4,), 4), ("u", (2, 7), None, (6,), 5)], [("c", (3, 3), None, (7,), 6)], []]):
        applier.newest_changes(spark.createDataFrame(rows, schema), ["k"]).write.mode("overwrite").parquet(f"{path}/d{n}")
        if n % 2:
            applier.compact_until(spark, path, n)
            applier.compact_until(spark, path, n)  # run again
    assert sorted(tuple(r) for r in applier.current(spark, path).collect()) == [(2, 7), (3, 3)]  # the late update of 1 stays deleted
    assert applier.versions(spark, path) == [1, 3] and applier.versions(spark, path, "d") == [2, 3, 4]


def test_restore(spark, tmp_path):
    rows = [("a", 0, 1, 100, 1, 7, "I", 1.0), ("b", 0, 1, 100, 1, 7, "I", 5.0), ("a", 0, 2, 200, 2, 7, "U", 2.0), ("a", 1, 3, 250, 3, 8, "I", 3.0), ("b", 0, 2, 260, 3, 8, "I", 4.0), ("b", 0, 3, 300, 4, 7, "D", None), ("a", 0, 4, 300, 4, 7, "U", 9.0)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset int, ts_ms bigint, txid int, k int, op string, v double")
    at = lambda t: {(r.topic, r.k, r.v) for r in ledger.restore(log, t, 100, 300, ["topic", "k"], ["v"]).collect()}
    assert at(100) == {("a", 7, 1.0), ("b", 7, 5.0)}  # T itself counts
    assert at(255) == {("a", 7, 2.0), ("b", 7, 5.0)}  # transaction 3 is not whole yet
    assert at(260) == {("a", 7, 2.0), ("b", 7, 5.0), ("a", 8, 3.0), ("b", 8, 4.0)} and at(300) == {("a", 7, 9.0), ("a", 8, 3.0), ("b", 8, 4.0)}
    for t in (99, 301):
        with pytest.raises(ledger.OutsideWindow):
            at(t)
    for t in (100, 260):
        ledger.write_restored(ledger.restore(log, t, 100, 300, ["topic", "k"], ["v"]), str(tmp_path), t)
    back = spark.read.parquet(str(tmp_path))
    assert {r.at_ms: r["count"] for r in back.groupBy("at_ms").count().collect()} == {100: 2, 260: 4}


def test_database_digest(spark):
    tables = {k: v.cache() for k, v in population(spark, 3).items()}
    whole = lambda t: {r.table_name: r.digest for r in fingerprint.database(fingerprint.clinic(t)).collect()}
    one = whole(tables)
    moved = dict(tables)
    moved["patients"] = tables["patients"].withColumn("patient_id", F.col("patient_id") + 5000)
    for t in ("appointments", "claims", "notes"):
        moved[t] = tables[t].withColumn("patient_id", F.col("patient_id") + 5000).repartition(3)
    assert whole(moved) == one and set(one) == {"*", "providers", "patients", "appointments", "claims", "notes"}
    other = dict(tables)
    other["claims"] = tables["claims"].withColumn("procedure_code", F.lit("1"))
    changed = whole(other)
    assert {k for k in one if one[k] != changed[k]} == {"*", "claims"}


def test_delete_all_and_truncates(spark):
    tables = {"a": spark.range(3), "b": spark.range(2).withColumn("a", F.col("id")), "c": spark.range(1).withColumn("b", F.col("id")).withColumn("c", F.col("id"))}
    refs = (cascade.Reference("b", "id", "a", "a", cascade.CASCADE), cascade.Reference("c", "id", "b", "b", cascade.CASCADE), cascade.Reference("c", "id", "c", "c", cascade.SET_NULL))
    got = cascade.delete_all(tables, refs)
    assert {(r.table_name, r.step): r["count"] for r in got.groupBy("table_name", "step").count().collect()} == {("c", 0): 1, ("b", 1): 2, ("a", 2): 3}
    with pytest.raises(ValueError):
        cascade.delete_all(tables, (*refs, cascade.Reference("a", "id", "id", "c", cascade.CASCADE)))
    ops = lambda *x: cascade.refuse_truncates(spark.createDataFrame([(o,) for o in x], "op string"))
    assert [r.op for r in ops("c", "d", None).collect()] == ["c", "d", None]
    with pytest.raises(Exception, match="TruncateRefused"):
        ops("c", "t").collect()
