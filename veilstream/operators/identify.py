"""Dense numbers for rows, without sorting them in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def dense_ids(df: DataFrame, order: list[str], out: str = "id", first: int = 1) -> DataFrame:
    """``df`` with the numbers first, first + 1, ... in ``order``, which should tell rows apart.

    A range-partitioned sort; one count a partition carries the numbers over partition borders.  Rows that tie
    get consecutive numbers in no particular order.  Nulls come first; an empty table stays empty.
    """
    mono = F.monotonically_increasing_id()
    rows = cut(df.orderBy(*order).withColumn("_part", F.shiftright(mono, 33)).withColumn("_at", F.pmod(mono, F.lit(1 << 33))))
    counts = sorted((r["_part"], r["n"]) for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, at = [], first
    for part, n in counts:
        starts.append((part, at))
        at += n
    known = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    return rows.join(F.broadcast(known), "_part").withColumn(out, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def at_rank(df: DataFrame, column: str, share: float):
    """The value at rank ceil(``share`` * rows) of all values that are not null (at least the first); None without any.

    An exact quantile by a range-partitioned sort: no task sees more than its range.
    """
    values = df.where(F.col(column).isNotNull()).select(column)
    ranked = dense_ids(values, [column], "_rank")
    at = max(1, math.ceil(share * values.count()))
    row = ranked.where(F.col("_rank") == at).first()
    return None if row is None else row[column]
