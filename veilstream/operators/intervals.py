"""Overlapping, nested and gapped intervals: continuous periods and the gaps between them.

Intervals [start, end) with integer bounds are range-partitioned by key and start, so that a key with a
third of all rows is spread over many tasks.  Batch by batch they are decomposed into canonical dyadic
blocks (level k: 2^k units, aligned to 2^k, at most two a level), blocks covered by an ancestor go, sibling
pairs merge upward and adjacent blocks coalesce to runs.  One summary row a (key, batch) carries how far the
batches before it reach, which is all that a later batch has to know.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Levels of blocks: whole numbers have 63 bits and a sign.
LEVELS = 63


def dyadic_blocks(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, level and index of the canonical blocks of the intervals [start, end)."""
    lo, hi, row = start.astype("int64"), end.astype("int64"), np.arange(len(start))
    rows, levels, indexes = [], [], []
    for k in range(LEVELS):
        live = lo < hi
        lo, hi, row = lo[live], hi[live], row[live]
        if not len(row):
            break
        left = (lo & 1) == 1
        rows.append(row[left])
        indexes.append(lo[left])
        levels.append(np.full(left.sum(), k))
        lo = lo + left
        right = ((hi & 1) == 1) & (lo < hi)
        hi = hi - right
        rows.append(row[right])
        indexes.append(hi[right])
        levels.append(np.full(right.sum(), k))
        lo, hi = lo >> 1, hi >> 1
    whole = [np.concatenate(x) if x else np.zeros(0, "int64") for x in (rows, levels, indexes)]
    return whole[0], whole[1], whole[2]


def merged_runs(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, start and end of the runs of each group's intervals; groups are numbers in order."""
    row, level, index = dyadic_blocks(start, end)
    group, start = group[row], np.left_shift(index, level)
    order = np.lexsort((-level, start, group))  # an ancestor starts no later and ends no earlier, so it comes first
    group, start, level = group[order], start[order], level[order]
    if not len(start):
        return group, start, start
    end = start + np.left_shift(np.int64(1), level)
    reach = pd.Series(end).groupby(group).cummax().to_numpy()
    keep = np.ones(len(start), bool)
    keep[1:] = (group[1:] != group[:-1]) | (end[1:] > reach[:-1])
    group, start, level = group[keep], start[keep], level[keep]
    k = int(level.min())
    while k <= level.max() and k < LEVELS - 1:
        here = level == k
        pair = np.zeros(len(start), bool)
        pair[:-1] = here[:-1] & here[1:] & (group[:-1] == group[1:]) & (((start[:-1] >> k) & 1) == 0) & (start[1:] - start[:-1] == 1 << k)
        if pair.any():
            level = np.where(pair, k + 1, level)
            stay = np.ones(len(start), bool)
            stay[1:] = ~pair[:-1]
            group, start, level = group[stay], start[stay], level[stay]
        k += 1
    end = start + np.left_shift(np.int64(1), level)
    first = np.ones(len(start), bool)
    first[1:] = (group[1:] != group[:-1]) | (start[1:] != end[:-1])
    last = np.append(first[1:], True)
    return group[first], start[first], end[last]


def _batches(key: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId() << 33
        for n, p in enumerate(batches):
            if not len(p):
                continue
            codes = pd.factorize(p[key], use_na_sentinel=False)[0].astype("int64")
            change = np.ones(len(p), bool)
            change[1:] = codes[1:] != codes[:-1]
            at = np.flatnonzero(change)
            g, s, e = merged_runs(np.cumsum(change) - 1, p["_from"].to_numpy("int64"), p["_to"].to_numpy("int64"))
            yield pd.DataFrame({key: p[key].to_numpy()[at[g]], "_cell": np.full(len(g), task + n), "_s": s, "_e": e})

    return run


def periods(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Columns ``key``, period_kind (busy or gap), starts_at, ends_at.

    ``start`` and ``end`` are whole numbers.  Intervals that overlap or touch form one busy
    period.  Rows with a null bound or end <= start are no intervals; a null key is a key of
    its own; repeated rows change nothing; other columns are ignored; an empty table gives no rows.
    An interval of any length is one row until it is in a batch, where it has at most two blocks a level.
    """
    bare = df.select(F.col(key), F.col(start).cast("bigint").alias("_from"), F.col(end).cast("bigint").alias("_to")).where("_from < _to")
    kind = df.schema[key].dataType.simpleString()
    ordered = bare.repartitionByRange(key, "_from").sortWithinPartitions(key, "_from", "_to")
    # batches are numbered as they come, so they are written once and read by both sides of the joins below
    runs = cut(ordered.mapInPandas(_batches(key), f"`{key}` {kind}, _cell bigint, _s bigint, _e bigint"))

    def back(rows: DataFrame, edges: DataFrame) -> DataFrame:
        edges = edges.withColumnsRenamed({key: "_k", "_cell": "_c"})
        return rows.join(edges, rows[key].eqNullSafe(F.col("_k")) & (F.col("_cell") == F.col("_c"))).drop("_k", "_c")

    forward = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    edges = runs.groupBy(key, "_cell").agg(F.max("_e").alias("_last"))
    edges = edges.withColumn("_carry", F.max("_last").over(forward)).withColumn("_whole", F.max("_last").over(Window.partitionBy(key))).drop("_last")
    inside = Window.partitionBy(key, "_cell").orderBy("_s")
    reached = back(runs, edges).withColumn("_reach", F.greatest("_carry", F.lag("_e").over(inside)))
    opens = reached.where("_reach IS NULL OR _s > _reach").withColumn("_next", F.lead("_reach").over(inside))
    # a period ends where what lies before the next one ends: of the next batch that opens any, a running value from the end
    backward = Window.partitionBy(key).orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    heads = opens.groupBy(key, "_cell").agg(F.min_by("_reach", "_s").alias("_head"))
    heads = heads.withColumn("_later", F.last("_head", ignorenulls=True).over(backward)).drop("_head")
    opens = back(opens, heads).withColumn("_end", F.coalesce("_next", "_later", "_whole"))
    parts = F.array(
        F.struct(F.lit("busy").alias("period_kind"), F.col("_s").alias("starts_at"), F.col("_end").alias("ends_at")),
        F.when(F.col("_reach").isNotNull(), F.struct(F.lit("gap").alias("period_kind"), F.col("_reach").alias("starts_at"), F.col("_s").alias("ends_at"))),
    )
    return opens.select(key, F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("p")).select(key, "p.period_kind", "p.starts_at", "p.ends_at")
