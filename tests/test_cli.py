import json

from pyspark.sql import functions as F

from veilstream import cli
from veilstream.operators.identify import dense_ids
from veilstream.operators.latest import latest_by_key

from .test_schema import ENVELOPE

POLICY = "tables: { public.t: { id: {op: hmac, domain: p}, name: {op: fake, kind: full_name}, zip: {op: generalize, to: zip3}, at: {op: date_shift, anchor: id}, ssn: {op: drop} } }"


def test_policy_schema_and_store(tmp_path, capsys):
    policy, raw = tmp_path / "p.yml", tmp_path / "raw.json"
    policy.write_text(POLICY)
    raw.write_text(json.dumps(ENVELOPE))
    assert cli.main(["policy", str(policy)]) == 0
    assert "public.t.zip" in capsys.readouterr().out
    assert cli.main(["schema", str(policy), "public.t", str(raw), "raw.public.t=clean.public.t"]) == 0
    clean = json.loads(capsys.readouterr().out)
    assert clean["namespace"] == "clean.public.t"
    for want in ("1", "1"):
        assert cli.main(["register", str(tmp_path / "store"), "clean.t", str(raw)]) == 0
        assert capsys.readouterr().out.strip() == want


def test_worked_examples(spark):
    out = cli.examples(spark)
    assert len(out) == 15 and len({r for _, v, r in out if "482" in v}) == 1


def test_churn_verifies_itself(spark, capsys):
    assert cli.main(["churn", "unused", "--dry-run", "--max-txns", "40"]) == 0
    assert "verified" in capsys.readouterr().out


def test_dense_ids(spark):
    df = spark.createDataFrame([(x,) for x in "dbca"] + [(None,)], "k string")
    assert [(r.k, r.id) for r in dense_ids(df.repartition(3), ["k"]).orderBy("id").collect()] == [(None, 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5)]
    assert dense_ids(df.limit(0), ["k"]).count() == 0


def test_latest_by_key(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (1, None, "none"), (2, None, "only"), (None, 1, "n"), (None, 2, "m")], "k int, t int, v string")
    assert {r.k: r.v for r in latest_by_key(df, ["k"], [F.col("t")]).collect()} == {1: "new", 2: "only", None: "m"}
