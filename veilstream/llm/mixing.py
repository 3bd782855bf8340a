"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected the same number of times (the source's rate).  The expected
copies are summed up in an order within the source, one random offset is added per source, and a
document is emitted once per whole number its stretch of the sum crosses: its copies differ by at
most one from the rate, and the source's number of documents by less than one from what was wanted.
Long documents are sampled first, and the others at the rate that makes up for what those gave too
much or too little; in the mean over offsets that is the source's rate again.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


@dataclass(frozen=True)
class SourcePlan:
    source: str
    target_weight: float
    max_repeats: int
    n_docs: int
    n_tokens: int
    wanted_share: float
    rate: float
    reachable_share: float = 0.0  # wanted, among the sources that can give anything


def plan_mix(rows: list[tuple[str, float | None, int | None, int, int]], total_tokens: int | None = None) -> list[SourcePlan]:
    """Rates for (source, weight, max_repeats, docs, tokens), one row per source.

    Without ``total_tokens`` the mix is the largest in which every source that has tokens meets its
    share within its cap, so shares are met but for whole documents.  With it, sources that reach
    their cap give what is left to the others in proportion to their weights.  Sources without a
    positive weight or cap, or without tokens, have rate 0; a null cap means 1.
    """
    weight = {s: Fraction(w) if w and w > 0 and w != float("inf") else Fraction(0) for s, w, *_ in rows}
    cap = {s: Fraction(1 if m is None else max(0, m)) for s, _, m, *_ in rows}
    tokens = {s: n for s, *_, n in rows}
    live = [s for s in weight if weight[s] > 0 and cap[s] > 0 and tokens[s] > 0]
    rate = dict.fromkeys(weight, Fraction(0))
    if live:
        whole = sum(weight[s] for s in live)
        if total_tokens is None:
            total = min(cap[s] * tokens[s] * whole / weight[s] for s in live)
            for s in live:
                rate[s] = total * weight[s] / whole / tokens[s]
        else:
            left, open_ = Fraction(total_tokens), list(live)
            while open_:
                whole_open = sum(weight[s] for s in open_)
                full = [s for s in open_ if left * weight[s] / whole_open >= cap[s] * tokens[s]]
                if not full:
                    for s in open_:
                        rate[s] = left * weight[s] / whole_open / tokens[s]
                    break
                for s in full:
                    rate[s] = cap[s]
                    left -= cap[s] * tokens[s]
                    open_.remove(s)
    asked = sum(weight.values())
    return [
        SourcePlan(
            s, float(w or 0.0), int(cap[s]), d, t, float(weight[s] / asked) if asked else 0.0, float(rate[s]), float(weight[s] / sum(weight[x] for x in live)) if s in live else 0.0
        )
        for s, w, _, d, t in rows
    ]


def offset(source: str, seed: int) -> float:
    """A random number in [0, 1) that depends on nothing but the source's name and the seed."""
    return int.from_bytes(hashlib.sha256(f"{seed}:{source}".encode()).digest()[:6], "big") / 2**48


def plan_sources(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> list[SourcePlan]:
    """The plan for a table of target sources.  One row per target source comes to the driver.

    ``targets`` is configuration (source, target_weight, max_repeats); repeated sources count once, with the
    greatest weight and cap.  Sources of documents that are no target, and null sources, are not mixed.
    """
    t = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_weight").alias("target_weight"), F.max("max_repeats").alias("max_repeats"))
    sizes = sized.where("n_tokens > 0").groupBy(F.col("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    got = t.join(sizes, "source", "left").select("source", "target_weight", "max_repeats", F.coalesce("n_docs", F.lit(0)).alias("d"), F.coalesce("n_tokens", F.lit(0)).alias("t")).collect()
    return plan_mix(sorted((r.source, r.target_weight, r.max_repeats, r.d, r.t) for r in got), total_tokens)


def _sampled(rows: DataFrame, id_column: str, seed: int) -> DataFrame:
    """``rows`` with ``_copies``: prefix sums of ``_rate`` in (source, hash bucket) by size, carried over buckets, plus ``_offset``."""
    rows = rows.withColumn("_b", F.pmod(F.xxhash64(F.col(id_column), F.lit(seed)), F.col("_buckets")))
    before = rows.groupBy("source", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("source").orderBy("_b")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("source", "_b").orderBy("n_tokens", id_column))
    rows = rows.withColumn("_rank", inside).join(before, ["source", "_b"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    crossed = lambda n: F.floor(n * F.col("_rate") + F.col("_offset"))
    return rows.withColumn("_copies", crossed(F.col("_rank")) - crossed(F.col("_rank") - 1))


def mix(sized: DataFrame, plan: list[SourcePlan], id_column: str = "doc_id", seed: int = 7, bucket_rows: int = 50_000, long: float = 0.005) -> DataFrame:
    """One row per use of a document: ``id_column``, source, n_tokens, copy_no (from 1).

    ``sized`` has ``id_column``, source, n_tokens.  Documents without tokens add nothing to a share and are left
    out.  The order within a source is by hash buckets of about ``bucket_rows`` rows, by size inside; bucket
    totals carry the sum over bucket borders, so a source that holds a third of all rows is spread over many
    tasks.  A document is long if it has more than the share ``long`` of the tokens its source is to give: a few
    such would else move a small source's share.  Repeated rows count as documents of their own; an empty table
    gives no rows.  The plan has a row per target source, which are configuration, so it is broadcast where the
    session's limit for broadcasts lets it; a number per target source is collected between the two samples.
    """
    spark = sized.sparkSession
    live = [p for p in plan if p.rate > 0]

    def rated(rates: dict[str, float], salt: int) -> DataFrame:
        drawn = [(p.source, rates[p.source], offset(p.source, seed + salt), max(1, -(-p.n_docs // bucket_rows)), long * p.rate * p.n_tokens) for p in live]
        return spark.createDataFrame(drawn, "source string, _rate double, _offset double, _buckets bigint, _long double")

    rows = sized.where("n_tokens > 0").select(id_column, "source", "n_tokens")
    head = cut(_sampled(rows.join(rated({p.source: p.rate for p in live}, 0), "source").where("n_tokens > _long"), id_column, seed).select(id_column, "source", "n_tokens", "_copies"))
    got = {r.source: (r.size, r.used) for r in head.groupBy("source").agg(F.sum("n_tokens").alias("size"), F.sum(F.col("n_tokens") * F.col("_copies")).alias("used")).collect()}
    rest = {}
    for p in live:
        size, used = got.get(p.source, (0, 0))
        left = p.n_tokens - size
        rest[p.source] = min(float(p.max_repeats), max(0.0, (p.rate * p.n_tokens - used) / left)) if left else 0.0
    tail = _sampled(rows.join(rated(rest, 1), "source").where("n_tokens <= _long"), id_column, seed).select(id_column, "source", "n_tokens", "_copies")
    used = head.unionByName(tail).where("_copies > 0")
    return used.select(id_column, "source", "n_tokens", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("copy_no"))


def shares(mixed: DataFrame, plan: list[SourcePlan]) -> DataFrame:
    """One row per target source: wanted and actual share, what was available and what the mix uses.

    ``gap`` is actual minus wanted share; it is not zero where a source has no tokens or its cap binds.
    ``reachable_share`` is the wanted share among the sources that have tokens.
    """
    spark = mixed.sparkSession
    asked = spark.createDataFrame(
        [(p.source, p.target_weight, p.max_repeats, p.n_docs, p.n_tokens, p.wanted_share, p.reachable_share, p.rate) for p in plan],
        "source string, target_weight double, max_repeats int, source_docs bigint, source_tokens bigint, wanted_share double, reachable_share double, rate double",
    )
    used = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("mix_docs"), F.sum("n_tokens").alias("mix_tokens"), F.max("copy_no").alias("most_copies"))
    out = asked.join(used, "source", "left").fillna(0, ["mix_docs", "mix_tokens", "most_copies"])
    whole = F.sum("mix_tokens").over(Window.partitionBy())
    return out.withColumn("actual_share", F.when(whole > 0, F.col("mix_tokens") / whole).otherwise(F.lit(0.0))).withColumn("gap", F.col("actual_share") - F.col("wanted_share"))
