"""Operators for data repair against brute force, and their edge cases."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from veilstream.functions.instants import instant_micros
from veilstream.operators import changefeed, drift, history, intervals, orphans
from veilstream.operators.ordered import neighbour
from veilstream.session import hot_keys, salted_join


def merged(spans):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


@pytest.mark.parametrize("seed,reach,longest", [(1, 200, 30), (2, 10**7, 10**6), (3, 64, 3), (4, 5000, 4000)])
def test_periods_equal_brute_force(spark, rows, seed, reach, longest):
    r = random.Random(seed)
    spans = [(r.choice([1, 1, 1, 2, 3, None]), s := r.randint(-reach, reach), s + r.randint(1, longest)) for _ in range(300)]
    df = spark.createDataFrame(spans + spans[:40], "k int, a bigint, b bigint").withColumn("_cell", F.lit("clash"))
    want = []
    for k in (1, 2, 3, None):
        m = merged([(s, e) for q, s, e in spans if q == k])
        want += [(k, "busy", s, e) for s, e in m] + [(k, "gap", x[1], y[0]) for x, y in zip(m, m[1:])]
    want.sort(key=lambda x: tuple((v is None, str(v)) for v in x))
    assert rows(intervals.periods(df, "k", "a", "b")) == want
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:  # many batches a key
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert rows(intervals.periods(df, "k", "a", "b")) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_canonical_blocks():
    import numpy as np

    for s, e in ((3, 17), (-5, 6), (0, 1), (-8, 0), (2**40 + 1, 2**41)):
        _, level, index = intervals.dyadic_blocks(np.array([s]), np.array([e]))
        got = sorted((i << k, (i + 1) << k) for k, i in zip(level.tolist(), index.tolist()))
        assert got[0][0] == s and got[-1][1] == e and all(x[1] == y[0] for x, y in zip(got, got[1:]))
        assert max(np.bincount(level)) <= 2


def test_periods_edges(spark, rows):
    df = spark.createDataFrame([("x", 5, 5), ("x", 9, 3), ("x", None, 3), ("x", 3, None)], "k string, a bigint, b bigint")
    assert rows(intervals.periods(df, "k", "a", "b")) == []
    assert rows(intervals.periods(df.limit(0), "k", "a", "b")) == []
    long = spark.createDataFrame([("x", 0, 2**26 + 7), ("x", 2**26 + 7, 2**26 + 9)], "k string, a bigint, b bigint")
    assert rows(intervals.periods(long, "k", "a", "b")) == [("x", "busy", 0, 2**26 + 9)]


def test_periods_of_a_key_with_a_third_of_all_rows_and_a_wild_interval(spark):
    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997 + 1).alias("k"), (F.col("id") * 97 % 50_000 * 100).alias("a"))
    df = df.withColumn("b", F.col("a") + 30 + F.col("a") % 90).unionByName(spark.createDataFrame([(0, -(2**61), -(2**40)), (5, 100, 2**61)], "k bigint, a bigint, b bigint"))
    got = intervals.periods(df, "k", "a", "b").cache()
    pdf = df.toPandas().sort_values(["k", "a"])
    pdf["reach"] = pdf.groupby("k").b.cummax().groupby(pdf.k).shift()
    opens = pdf[pdf.reach.isna() | (pdf.a > pdf.reach)]
    assert got.where("period_kind = 'busy'").count() == len(opens) and got.where("period_kind = 'gap'").count() == len(opens) - pdf.k.nunique()
    assert got.where("k = 5 AND ends_at = 2305843009213693952").count() == 1 and got.where("starts_at >= ends_at").count() == 0


def test_instants(spark):
    cases = {
        "2026-03-02T09:15:00Z": 1772442900000000, "2026-03-02 11:15:00.5+02:00": 1772442900500000, "2026-03-02T14:45:00+0530": 1772442900000000, " 2026-03-02t09:15:00z ": 1772442900000000,
        "2026-03-02T09:15Z": 1772442900000000, "0000-00-00T00:00:00Z": None, "2026-02-30T00:00:00Z": None, "TBD": None, "": None, "2026-03-02": None, "2026-03-02T09:15:00": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert [r[0] for r in df.select(instant_micros(F.col("t"))).collect()] == list(cases.values())


def test_neighbours_cross_buckets(spark):
    r = random.Random(5)
    data = [(r.choice("aab"), i, r.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    back = {(x.k, x.i): x.p.v if x.p else None for x in neighbour(df, ["k"], F.shiftright("i", 3), ["i"], ["v"], "p").collect()}
    ahead = {(x.k, x.i): x.p.v if x.p else None for x in neighbour(df, ["k"], F.shiftright("i", 3), ["i"], ["v"], "p", ahead=True).collect()}
    for k in "ab":
        own = [(i, v) for q, i, v in data if q == k]
        for x, y in zip(own, own[1:]):
            assert back[k, y[0]] == x[1] and ahead[k, x[0]] == y[1]


def test_salted_join_keeps_every_row(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 1), (None, 2), ("lone", 3)], "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3), (None, 9)], "k string, v int")
    assert [tuple(r) for r in hot_keys(left, ["k"], 100).collect()] == [("hot", 10)]
    got = salted_join(left, right, ["k"], F.col("i"), hot_rows=100)
    assert got.count() == 1000 + 1 + 2 and got.where("k = 'lone' AND v IS NULL").count() == 1
    for how in ("left_semi", "left_anti"):
        some = salted_join(left, right, ["k"], F.col("i"), how, 100)
        assert some.columns == ["k", "i"] and some.exceptAll(left.join(right, "k", how)).count() == 0 and some.count() == left.join(right, "k", how).count()
    assert got.select("k", "i", "v").exceptAll(left.join(right, "k", "left").select("k", "i", "v")).count() == 0


def day(n):
    return datetime(2026, 1, n)


def test_orphans_direct_and_inherited(spark, rows):
    tables = {
        "patients": spark.createDataFrame([(1, day(1)), (2, day(9)), (2, day(20)), (None, day(1))], "id bigint, loaded_at timestamp"),
        "visits": spark.createDataFrame([(10, 1, day(2)), (10, 1, day(3)), (11, 2, day(5)), (12, 7, day(5)), (13, 8, day(5)), (14, None, day(5)), (None, 7, day(5)), (15, None, None)], "id bigint, pid bigint, loaded_at timestamp"),
        "bills": spark.createDataFrame([(100, 12, day(6)), (101, 13, day(6)), (102, 11, day(6)), (103, 99, day(6)), (104, 10, day(1))], "id bigint, vid bigint, loaded_at timestamp"),
        "lines": spark.createDataFrame([(1000, 100, day(7)), (1001, 1000, day(7))], "id bigint, bid bigint, loaded_at timestamp"),
    }
    keys = [orphans.ForeignKey("visits", "id", "pid", "patients", "id"), orphans.ForeignKey("bills", "id", "vid", "visits", "id"), orphans.ForeignKey("lines", "id", "bid", "bills", "id")]
    gone = spark.createDataFrame([(" Public.PATIENTS ", 8, day(4)), ("patients", 1, day(4))], "source_table string, row_id bigint, deleted_at timestamp")
    found = orphans.orphans(tables, keys, gone)
    assert rows(found.select("child_table", "child_id", "orphan_kind", "lineage", "round")) == sorted([
        ("visits", 11, "late", "direct", 0), ("visits", 12, "missing", "direct", 0), ("visits", 13, "deleted", "direct", 0), ("bills", 103, "missing", "direct", 0), ("bills", 104, "late", "direct", 0),
        ("lines", 1001, "missing", "direct", 0), ("bills", 100, "inherited", "inherited", 1), ("bills", 101, "inherited", "inherited", 1), ("lines", 1000, "inherited", "inherited", 2),
    ], key=lambda r: tuple((False, str(x)) for x in r))
    assert orphans.orphan_report(found).agg(F.sum("n_refs")).first()[0] == 9
    assert rows(orphans.orphans({k: t.limit(0) for k, t in tables.items()}, keys, gone.limit(0))) == []


def test_orphan_cycles_end(spark):
    notes = spark.createDataFrame([(1, 2, day(1)), (2, 1, day(1)), (3, 9, day(1)), (4, 3, day(1)), (9, 9, day(1))], "id bigint, amends bigint, loaded_at timestamp").where("id <> 9")
    found = orphans.orphans({"notes": notes}, [orphans.ForeignKey("notes", "id", "amends", "notes", "id")])
    assert sorted((r.child_id, r.lineage) for r in found.collect()) == [(3, "direct"), (4, "inherited")]


LOG = "op string, before_row struct<id:bigint,v:string>, after_row struct<id:bigint,v:string>, ts_ms bigint, source_lsn bigint, transaction_order bigint, topic_offset bigint"


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_change_feed_equals_replay_in_order(spark, rows, batches):
    r = random.Random(batches)
    state, log = {}, []
    for lsn in range(400):
        k = r.choice([1, 1, 1, *range(20)])
        if k in state and r.random() < 0.3:
            log.append(("d", (k, None), None, None, lsn, None, lsn))
            del state[k]
        else:
            state[k] = str(lsn)
            log.append(("u" if r.random() < 0.5 else "c", None, (k, str(lsn)), lsn, lsn, 1, lsn))
    shuffled = log + r.choices(log, k=80)
    r.shuffle(shuffled)
    got = changefeed.resolve(spark.createDataFrame(shuffled, LOG), "id", batches=batches)
    assert rows(got.select("id", "v")) == sorted(state.items(), key=lambda x: ((False, str(x[0])), (False, x[1])))


def test_change_feed_edges(spark, rows):
    log = spark.createDataFrame(
        [
            ("u", (1, "a"), (2, "b"), 1, 10, 1, 1), ("d", (3, None), None, 1, 11, 1, 2), ("c", None, None, 1, 12, 1, 3), ("d", None, None, 1, 13, 1, 4), ("c", None, (5, "x"), 1, None, 1, 5), ("m", None, (6, "m"), 1, 14, 1, 6),
            ("c", None, (None, "n"), 1, 15, 1, 7),
        ], LOG,
    )
    base = spark.createDataFrame([(1, "old"), (3, "old"), (8, "stays"), (8, "stays")], "id bigint, v string")
    got = changefeed.resolve(log, "id", base)
    assert rows(got.select("id", "v", "source_lsn")) == [(2, "b", 10), (5, "x", None), (8, "stays", None), (8, "stays", None)]
    assert rows(changefeed.resolve(log.limit(0), "id", base).select("id")) == [(1,), (3,), (8,), (8,)]
    assert rows(changefeed.resolve(log.limit(0), "id")) == []
    assert rows(changefeed.tombstones(log, "id").select("id")) == [(1,), (3,)]


def brute_versions(seen):
    out = []
    for k in {k for k, *_ in seen}:
        prev = starts = None
        starts = []
        for at, pair in sorted({(t, p) for q, t, p in seen if q == k and t is not None}):
            if pair != prev:
                starts.append(at)
            prev = pair
        out += [(k, a, b) for a, b in zip(starts, starts[1:] + [-1])]
    return sorted(out)


def test_history_in_any_order_of_batches(spark, rows):
    r = random.Random(8)
    times = {}
    raw = []
    for _ in range(300):
        k, t = r.randint(1, 6), r.randint(0, 40) << 31
        v = times.setdefault((k, t), (r.choice(["A@x", "b@y", "", None]), r.choice(["1", "2"])))
        raw.append((k, r.choice([v[0], f" {v[0].lower()} " if v[0] else None]), v[1], t if r.random() > 0.05 else None))
    df = spark.createDataFrame(raw, "k int, email string, zip string, t bigint")
    want = brute_versions([(k, t, ((e or "").strip().lower() or None, z)) for k, e, z, t in raw])
    once = history.versions(history.merge_history(None, df, "k", ["email", "zip"], F.col("t")), "k", ["email", "zip"])
    assert sorted((x.k, x.valid_from_ms, x.valid_to_ms) for x in once.collect()) == want
    for batches in (1, 3):
        folded = history.fold(df, "k", ["email", "zip"], F.col("t"), batches)
        assert sorted((x.k, x.valid_from_ms, x.valid_to_ms) for x in folded.collect()) == want
    assert history.fold(df.limit(0), "k", ["email", "zip"], F.col("t")).count() == 0
    state = None
    for part in (df.where("t % 3 = 2"), df.where("t % 3 = 0 OR t IS NULL"), df.where("t % 3 = 1")):
        state = history.merge_history(state, part, "k", ["email", "zip"], F.col("t"))
    assert sorted((x.k, x.valid_from_ms, x.valid_to_ms) for x in history.versions(state, "k", ["email", "zip"]).collect()) == want
    assert rows(history.versions(history.merge_history(None, df.limit(0), "k", ["email", "zip"], F.col("t")), "k", ["email", "zip"])) == []


def files(spark, spec):
    """spec: topic -> list of (file, ts, list of after images)."""
    out = []
    for topic, fs in spec.items():
        for name, ts, images in fs:
            for n, image in enumerate(images):
                p = image if isinstance(image, str) else json.dumps({"before": None, "after": image, "source": {"table": topic.split(".")[-1], "ts_ms": ts + n, "lsn": ts + n}, "op": "u", "ts_ms": ts})
                out.append((topic, name, n, datetime(2026, 1, 1), p))
    return spark.createDataFrame(out + out[:2], "topic string, file_name string, line_no int, landed_at timestamp, payload string")


DRIFT = {
    "s.public.claims": [
        ("b.json", 100, [{"claim_id": i, "paid": i * 1.5, "code": f"P{i}", "open": True, "due": "2024-06-10T18:40:00Z"} for i in range(1, 6)]),
        ("a.json", 200, [{"claim_id": i, "amount": i * 1.5, "code": f"P{i}", "due_ms": 1718044800000} for i in range(1, 6)] + ["{broken"]),
        ("c.json", 300, [{"claim_id": i, "amount": None, "code": [f"P{i}"], "due_ms": 1718044800000} for i in range(1, 6)]),
        ("d.json", 400, [{"claim_id": i, "amount_v2": str(i * 1.5), "code": None, "due_ms": 1718044800000, "paid": 7} for i in range(1, 6)]),
    ],
    "s.public.notes": [("z.json", 50, [{"note_id": 1, "x": 1}]), ("y.json", 60, [{"note_id": 1, "x": 2.5}, {"note_id": 2, "y": {"k": 1}}])],
}


def test_drift(spark, rows):
    changes, named, _ = drift.drift(files(spark, DRIFT))
    c = "s.public.claims"
    assert rows(changes) == sorted([
        (c, "a.json", "paid", "renamed", "amount"), (c, "a.json", "open", "removed", ""), (c, "a.json", "due", "renamed", "due_ms"), (c, "a.json", "due_ms", "retyped", ""), (c, "c.json", "code", "retyped", ""),
        # all values of amount are null in c.json, so no rows can show that it became amount_v2
        (c, "d.json", "amount", "removed", ""), (c, "d.json", "amount_v2", "added", ""), (c, "d.json", "paid", "added", ""),
        ("s.public.notes", "y.json", "x", "retyped", ""), ("s.public.notes", "y.json", "y", "added", ""),
    ], key=lambda r: tuple((False, x) for x in r))
    assert rows(drift.drift(files(spark, DRIFT).limit(0))[0]) == []


def test_drift_follows_chains_of_renames(spark):
    images = lambda name, kind: [{"note_id": i, name: kind(i)} for i in range(4)]
    spec = {"s.public.notes": [(f"{n}.json", 100 * n, images(name, kind)) for n, (name, kind) in enumerate([("a", int), ("b", int), ("c", str), ("d", str), ("e", lambda i: [i])])]}
    changes, named, _ = drift.drift(files(spark, spec))
    got = {(r.file_name, r.change_kind, r.field_name, r.new_name) for r in changes.collect()}
    assert got == {("1.json", "renamed", "a", "b"), ("2.json", "renamed", "b", "c"), ("2.json", "retyped", "c", ""), ("3.json", "renamed", "c", "d"), ("4.json", "renamed", "d", "e"), ("4.json", "retyped", "e", "")}
    assert {r.attribute for r in named.where("field_name <> 'note_id'").collect()} == {"a"}


def test_consistent_table(spark):
    t = drift.consistent_table(files(spark, DRIFT), "claims")
    types = dict(t.dtypes)
    assert types["claim_id"] == "bigint" and types["paid"] == "double" and types["open"] == "boolean" and types["code"] == "string" and types["due"] == "string"
    assert t.where("file_name = 'a.json' AND paid = 3.0 AND due = '1718044800000'").count() == 1 and t.count() == 20 + 2
    assert drift.consistent_table(files(spark, DRIFT), "nothing").count() == 0


def odd_envelopes():
    """name -> files of one topic: what a JSON reader, a key or a place in the log may look like."""
    topic = "s.public.notes"
    of = lambda f, kind=lambda i: i, key=lambda i: i: [{"note_id": key(i), f: kind(i)} for i in range(5)]
    line = lambda after, **source: json.dumps({"after": after, "source": {"table": "notes", **source}})
    spec = {
        "keys that become text": (topic, [of("a"), of("b", key=str)]),
        "unreadable line, other table": (topic + "_v2", [[line(x, ts_ms=1, lsn=n) for n, x in enumerate(of("a"))] + ["{bad"], [line(x, ts_ms=2, lsn=n) for n, x in enumerate(of("b"))]]),
        "no readable line": (topic, [of("a"), ["{bad", "nope"], of("a")]),
        "no number": (topic, [of("a"), ['{"source": {"ts_ms": 200, "lsn": 9, "table": "notes"}, "after": {"note_id": 9, "b": NaN}}']]),
        "times as text": (topic, [[line(x, ts_ms=str(900 - k), lsn=str(n)) for n, x in enumerate(of(f))] for k, f in enumerate("ab")]),
        "no place in the log": (topic, [[line({"note_id": 1, f: v}, ts_ms=k, **({"lsn": 5} if v < 2 else {})) for v in (1, 2)] + [line({"note_id": i, f: i}, ts_ms=k, lsn=6) for i in (3, 4)] for k, f in enumerate("ab")]),
        "containers": (topic, [of("a", lambda i: {"x": {"y": i}}), of("b", lambda i: {"z": {"y": i}}), of("c", lambda i: [i, None]), of("d", lambda i: [i])]),
        "wide numbers": (topic, [of("a", lambda i: 2**63 + i), of("a", lambda i: 2**70 + i)]),
        "every kind": (topic, [of("a", lambda i: [1, 2.5, "x", True, [1]][i]), of("a", lambda i: None), of("a", str)]),
    }
    return {name: {topic: [(f"f{k}.json", 100 * (k + 1), images) for k, images in enumerate(fs)]} for name, (topic, fs) in spec.items()}


@pytest.mark.parametrize("name", odd_envelopes())
def test_drift_of_odd_envelopes_equals_sql(spark, tmp_path, name):
    import duckdb

    from veilstream.queries import drifting

    files(spark, odd_envelopes()[name]).write.parquet(f"{tmp_path}/envelope_files.parquet")
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    c.execute(f"CREATE VIEW envelope_files AS SELECT * FROM '{tmp_path}/envelope_files.parquet/*.parquet'")
    for query in ("p2_schema", "p2_found"):
        got = sorted(str(tuple(r)) for r in drifting.QUERIES[query](spark, str(tmp_path)).collect())
        assert got == sorted(map(str, c.execute(drifting.SQL[query]).fetchall())), query


def test_the_kind_of_all_files_is_the_join_of_theirs(spark):
    """The fold: kinds of a set of bits join to the kind of the bits together, whatever the order."""
    chain = {None: 0, "whole number": 1, "number with fraction": 2}

    def join(a, b):
        if a is None or b is None or a == b:
            return a or b
        return "number with fraction" if a in chain and b in chain else "mixed"

    kinds = {r.m: r.k for r in spark.range(128).select(F.col("id").alias("m"), drift.kind_of(F.col("id")).alias("k")).collect()}
    assert all(kinds[a | b] == join(kinds[a], kinds[b]) for a in kinds for b in kinds)


def test_consistent_table_loses_no_wide_number_and_no_line(spark):
    spec = files(spark, odd_envelopes()["wide numbers"]).where("file_name = 'f0.json'")
    lost = spark.createDataFrame([("s.public.notes", None, 9, datetime(2026, 1, 1), json.dumps({"after": {"note_id": 9, "a": 2}, "source": {"table": "notes"}}))], spec.schema)
    t = drift.consistent_table(spec.unionByName(lost), "notes")
    assert dict(t.dtypes)["a"] == "decimal(38,0)" and {int(r.a) for r in t.collect()} == {2, *range(2**63, 2**63 + 5)}


def test_history_of_one_long_key(spark):
    """A key over many stretches, with runs that go on over their borders."""
    step = 1 << 31
    data = [(7, i * step, "x" if i // 9 % 2 else "y") for i in range(120)] + [(None, 5, "z"), (8, -3 * step, "a"), (8, 90 * step, "a")]
    df = spark.createDataFrame(data, "k int, t bigint, v string")
    got = sorted((x.k or 0, x.valid_from_ms, x.valid_to_ms) for x in history.fold(df, "k", ["v"], F.col("t")).collect())
    starts = [i * step for i in range(0, 120, 9)]
    assert got == sorted([(0, 5, -1), (8, -3 * step, -1)] + [(7, a, b) for a, b in zip(starts, [*starts[1:], -1])])
