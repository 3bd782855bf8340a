"""Neighbours in an order (lag / lead) without collecting a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & a[n].eqNullSafe(b[n])
    return on


def neighbour(df: DataFrame, keys: list[str], bucket: Column, order: list[str], values: list[str], out: str, ahead: bool = False) -> DataFrame:
    """Adds ``out``: a struct of ``values`` of the row before (or after, if ``ahead``) in ``order`` within ``keys``.

    ``bucket`` must not decrease along ``order``.  Rows are compared inside their (keys, bucket)
    only; one summary row per bucket carries the value over bucket borders.  A key that holds
    a third of all rows is thus spread over its buckets, and only its summary rows meet in a task.
    Ties in ``order`` are broken by the values, so repeated rows give a defined result.
    """
    if not keys:
        df = df.withColumn("_one", F.lit(0))
        return neighbour(df, ["_one"], bucket, order, values, out, ahead).drop("_one")
    tie = order + [v for v in values if v not in order]
    df = df.withColumn("_b", bucket).withColumn("_v", F.struct(*values))
    near = F.lead if ahead else F.lag
    inner = Window.partitionBy(*keys, "_b").orderBy(*tie)
    rows = df.withColumn("_near", near("_v").over(inner))
    pick = F.min_by if ahead else F.max_by
    edge = df.groupBy(*keys, "_b").agg(pick("_v", F.struct(*tie)).alias("_edge"))
    edge = edge.withColumn("_carry", near("_edge").over(Window.partitionBy(*keys).orderBy("_b"))).drop("_edge")
    edge = edge.where("_carry IS NOT NULL")
    got = rows.join(edge, _same(rows, edge, [*keys, "_b"]), "left")
    return got.select(*[rows[c] for c in df.columns if c not in ("_b", "_v")], F.coalesce(rows["_near"], edge["_carry"]).alias(out))
