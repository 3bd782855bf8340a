import pytest
from pyspark.sql import functions as F

from veilstream.llm import mixing


def test_plan_meets_shares_within_caps():
    plan = {p.source: p for p in mixing.plan_mix([("a", 3.0, 1, 10, 1000), ("b", 1.0, 4, 5, 50), ("none", 1.0, 2, 0, 0), ("off", 0.0, 2, 3, 30), ("null", None, None, 3, 30)])}
    used = {s: p.rate * p.n_tokens for s, p in plan.items()}
    assert used["b"] == 200 and used["a"] == 600 and used["none"] == used["off"] == used["null"] == 0
    assert sum(p.wanted_share for p in plan.values()) == pytest.approx(1)


def test_plan_with_a_total_passes_on_what_caps_leave():
    plan = {p.source: p for p in mixing.plan_mix([("a", 1.0, 1, 1, 1000), ("b", 1.0, 2, 1, 100), ("c", 2.0, 1, 1, 5000)], 2000)}
    assert plan["b"].rate == 2 and plan["a"].rate * 1000 == pytest.approx(600) and plan["c"].rate * 5000 == pytest.approx(1200)
    every = mixing.plan_mix([("a", 1.0, 1, 1, 10), ("b", 1.0, 2, 1, 10)], 10**9)
    assert [p.rate for p in every] == [1, 2] and mixing.plan_mix([]) == []


def test_mix(spark):
    sized = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "big").when(F.col("id") < 2100, "small").when(F.col("id") < 2110, F.lit(None)).otherwise("other").alias("source"), (F.col("id") % 50).alias("n_tokens"), F.lit(1).alias("copy_no"))
    targets = spark.createDataFrame([("big", 2.0, 1), ("small", 1.0, 3), ("absent", 1.0, 2), (None, 5.0, 1), ("small", 0.5, 1)], "source string, target_weight double, max_repeats int")
    plan = mixing.plan_sources(sized, targets)
    out = mixing.mix(sized, plan, bucket_rows=64).cache()
    counts = out.groupBy("source", "doc_id").count()
    rate = {p.source: p.rate for p in plan}
    for s in ("big", "small"):
        got = {r["count"] for r in counts.where(F.col("source") == s).select("count").distinct().collect()}
        assert got <= {int(rate[s]), int(rate[s]) + 1, -int(-rate[s] // 1)} and max(got) <= {"big": 1, "small": 3}[s]
    assert out.where("n_tokens = 0").count() == 0 and {r.source for r in out.select("source").distinct().collect()} == {"big", "small"}
    shares = {r.source: r for r in mixing.shares(out, plan).collect()}
    assert shares["absent"].actual_share == 0 and shares["absent"].wanted_share == 0.25
    assert shares["big"].actual_share == pytest.approx(2 / 3, abs=0.01) and shares["small"].most_copies == 3
    again = mixing.mix(sized.repartition(7), plan, bucket_rows=64)
    assert again.exceptAll(out.select(again.columns)).count() == 0
    assert mixing.mix(sized.limit(0), mixing.plan_sources(sized.limit(0), targets)).count() == 0


def test_long_documents_are_made_up_for(spark):
    sized = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.when(F.col("id") % 400 == 0, 20_000).otherwise(F.col("id") % 90 + 1).alias("n_tokens"))
    plan = mixing.plan_sources(sized, spark.createDataFrame([("a", 1.0, 2), ("b", 1.0, 1)], "source string, target_weight double, max_repeats int"))
    for seed in range(4):
        shares = {r.source: r for r in mixing.shares(mixing.mix(sized, plan, seed=seed), plan).collect()}
        assert abs(shares["a"].gap) < 0.01 and abs(shares["b"].gap) < 0.01 and shares["a"].most_copies <= 2
