"""Full history of changing attributes (type-two dimension) from snapshots or updates.

A batch of observations is merged into the history: attribute hashes are compared with those of the current
versions, changed versions are closed and new ones opened.  Batches that follow each other in time touch
nothing but current versions (``merge_batch``, ``fold``).  Where observations arrive late, the history keeps
every distinct observation, so that late batches give the same versions as early ones (``merge_history``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .ordered import neighbour

#: Observations of one key are compared in stretches of 2^33 ms (about 99 days).
STRETCH = 33


def tidy(c: Column) -> Column:
    """Case and outer blanks do not matter; blank equals null."""
    t = F.lower(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""))
    return F.when(t != "", t)


def attribute_hash(columns: list[str]) -> Column:
    """SHA-256 (32 bytes) of the tidied attributes; null and text cannot meet, nor can neighbouring values."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.length(tidy(F.col(c))).cast("string"), F.lit(":"), tidy(F.col(c))), F.lit("n")) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def observations(updates: DataFrame, key: str, attributes: list[str], at_ms: Column) -> DataFrame:
    """Distinct observations: key, at_ms, attributes, hash.  Rows without a readable instant are left out."""
    seen = updates.select(F.col(key), at_ms.cast("bigint").alias("at_ms"), *attributes).withColumn("hash", attribute_hash(attributes)).where("at_ms IS NOT NULL")
    return seen.groupBy(key, "at_ms", "hash").agg(*[F.min(a).alias(a) for a in attributes])


def runs(rows: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """key, attributes, hash, valid_from_ms, valid_to_ms (-1: open) of the runs of equal hashes per key.

    Rows are ordered by at_ms and hash inside (key, stretch); one summary row a stretch carries the hash before
    it and the next start after it over its borders.  So a key with a third of all rows is spread over its
    stretches, and rows are partitioned once.
    """
    inside = Window.partitionBy(key, "_b").orderBy("at_ms", "hash")
    marked = rows.withColumn("_b", F.shiftright("at_ms", STRETCH)).withColumn("_was", F.lag("hash").over(inside))
    starts = marked.where("_was IS NULL OR _was <> hash").withColumn("_next", F.lead("at_ms").over(inside))
    at = F.struct("at_ms", "hash")
    edges = starts.groupBy(key, "_b").agg(
        F.min("at_ms").alias("_first_at"), F.min_by("hash", at).alias("_first"), F.max_by("hash", at).alias("_last"), F.min(F.when(F.col("_was").isNotNull(), F.col("at_ms"))).alias("_second_at")
    )
    forward = Window.partitionBy(key).orderBy("_b")
    edges = edges.withColumn("_before", F.lag("_last").over(forward))
    edges = edges.withColumn("_start", F.when(F.col("_before").isNull() | (F.col("_before") != F.col("_first")), F.col("_first_at")).otherwise(F.col("_second_at")))
    # the next start of a later stretch: a running value from the end
    backward = Window.partitionBy(key).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_later", F.last("_start", ignorenulls=True).over(backward)).select(F.col(key).alias("_k"), F.col("_b").alias("_eb"), "_before", "_later")
    got = starts.join(edges, starts[key].eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_eb")))
    opens = F.col("_was").isNotNull() | F.col("_before").isNull() | (F.col("_before") != F.col("hash"))
    to = F.coalesce("_next", "_later", F.lit(-1).cast("bigint"))
    return got.where(opens).select(key, *attributes, "hash", F.col("at_ms").alias("valid_from_ms"), to.alias("valid_to_ms"))


def merge_batch(current: DataFrame | None, batch: DataFrame, key: str, attributes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(closed versions, current versions) after a batch of observations that are later than the starts of ``current``.

    The hash of a current version is compared with the key's first observation: if it differs, the version is
    closed there and a new one opened.  Current versions of other keys stay; closed ones are never read again.
    """
    if current is not None:
        batch = batch.unionByName(current.select(key, F.col("valid_from_ms").alias("at_ms"), *attributes, "hash"))
    merged = cut(runs(batch, key, attributes))
    return merged.where("valid_to_ms >= 0 OR valid_to_ms < -1"), merged.where("valid_to_ms = -1")


def fold(updates: DataFrame, key: str, attributes: list[str], at_ms: Column, batches: int = 4) -> DataFrame:
    """key, attributes, hash, valid_from_ms, valid_to_ms of all versions, by merges of ``batches`` slices of time, oldest first.

    Borders are approximate quantiles of the instants: they only decide how the work is split.  Rows without a
    readable instant are left out; repeated rows and rows that change nothing open no version; two different
    observations of one instant are ordered by their hash, the first being valid for no time.  Null keys are a key.
    """
    seen = cut(observations(updates, key, attributes, at_ms))
    cuts = sorted({int(x) for x in seen.approxQuantile("at_ms", [i / batches for i in range(1, batches)], 0.01)}) if batches > 1 else []
    edges: list[int | None] = [None, *cuts, None]
    versions, current = None, None
    for low, high in zip(edges, edges[1:]):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("at_ms") >= low)
        if high is not None:
            inside = inside & (F.col("at_ms") < high)
        closed, current = merge_batch(current, seen.where(inside), key, attributes)
        versions = closed if versions is None else versions.unionByName(closed)
    return versions.unionByName(current)


def merge_history(history: DataFrame | None, updates: DataFrame, key: str, attributes: list[str], at_ms: Column) -> DataFrame:
    """The history after a batch: key, at_ms, hash, attributes, opens (whether a version starts there).

    Only keys of the batch are worked on; the others pass through.  Two different observations of one
    instant are ordered by their hash, so the result is defined.  Merging batches in any order gives one result.
    """
    new = observations(updates, key, attributes, at_ms)
    rest = None
    if history is not None:
        touched = new.select(F.col(key).alias("_k")).distinct()
        same = history[key].eqNullSafe(F.col("_k"))
        rest = history.join(touched, same, "left_anti")
        old = history.join(touched, same, "left_semi").drop("opens")
        new = new.unionByName(old).groupBy(key, "at_ms", "hash").agg(*[F.min(a).alias(a) for a in attributes])
    seen = neighbour(new, [key], F.shiftright("at_ms", STRETCH), ["at_ms", "hash"], ["hash"], "_current")
    changed = F.col("_current").isNull() | (F.col("_current.hash") != F.col("hash"))
    merged = seen.withColumn("opens", changed).drop("_current").select(key, "at_ms", "hash", *attributes, "opens")
    return merged if rest is None else merged.unionByName(rest)


def versions(history: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """key, attributes, valid_from_ms, valid_to_ms (-1: still valid), is_current.

    Where two different observations share an instant, the later-ordered one opens its version there and the
    other is valid for no time.
    """
    starts = history.where("opens").select(key, *attributes, "hash", F.col("at_ms").alias("valid_from_ms"))
    closed = neighbour(starts, [key], F.shiftright("valid_from_ms", STRETCH), ["valid_from_ms", "hash"], ["valid_from_ms"], "_next", ahead=True)
    return closed.withColumn("valid_to_ms", F.coalesce("_next.valid_from_ms", F.lit(-1).cast("bigint"))).withColumn("is_current", F.col("_next").isNull()).select(key, *attributes, "valid_from_ms", "valid_to_ms", "is_current")
