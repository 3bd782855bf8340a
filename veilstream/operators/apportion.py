"""Sharing out whole numbers, and keeping instants of a group apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .identify import dense_ids


def largest_remainder(df: DataFrame, key: str, weight: Column, total: int, out: str = "share") -> DataFrame:
    """``df`` with whole numbers that add up to ``total`` in proportion to ``weight``.

    Everyone gets the whole part of their quota, and those with the largest remainders one more (ties by ``key``).
    Weights that are null or negative count as 0; if all are 0 everyone's is 1.  Remainders are ranked by a
    range-partitioned sort by remainder and key, so equal remainders are spread, too.  An empty table stays empty.
    """
    df = df.withColumn("_w", F.when(weight > 0, weight).otherwise(F.lit(0)).cast("double"))
    sums = df.agg(F.sum("_w").alias("_sum"), F.count(F.lit(1)).alias("_rows")).first()
    quota = F.col("_w") * F.lit(total) / F.lit(sums["_sum"]) if sums["_sum"] else F.lit(float(total)) / F.lit(max(1, sums["_rows"]))
    df = df.withColumn("_q", quota).withColumn("_base", F.floor("_q")).withColumn("_less", F.col("_base") - F.col("_q"))
    left = total - (df.agg(F.sum("_base").alias("s")).first()["s"] or 0)
    ranked = dense_ids(df, ["_less", key], "_rank")
    return ranked.withColumn(out, (F.col("_base") + F.when(F.col("_rank") <= left, 1).otherwise(0)).cast("bigint")).drop("_w", "_q", "_base", "_less", "_rank")


def spread_instants(df: DataFrame, group: list[str], instant: str, tie: str, step_us: int = 1, stretch: int = 36) -> DataFrame:
    """``instant`` moved later in steps, as little as needed for all of a group to differ.

    Taken in order of instant and ``tie``, each is the later of its own and the one before plus a step; in closed
    form a running maximum.  It is taken in stretches of 2^``stretch`` microseconds, with one row each that carries
    the count and the maximum over their borders, so a group with a third of all rows is spread over its stretches.
    Null instants stay null.
    """
    micros = F.unix_micros(F.col(instant).cast("timestamp"))
    rows = df.where(F.col(instant).isNotNull()).withColumn("_b", F.shiftright(micros, stretch))
    inside = Window.partitionBy(*group, "_b").orderBy(instant, tie)
    rows = rows.withColumn("_i", F.row_number().over(inside)).withColumn("_lead", micros - F.col("_i") * F.lit(step_us))
    rows = rows.withColumn("_top", F.max("_lead").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    edges = rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"), F.max("_lead").alias("_most"))
    earlier = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    edges = edges.withColumn("_carry", F.max(F.col("_most") - F.col("_before") * F.lit(step_us)).over(earlier))
    names = {g: f"_g{i}" for i, g in enumerate(group)}
    edges = edges.select(*[F.col(g).alias(n) for g, n in names.items()], F.col("_b").alias("_eb"), "_before", "_carry")
    same = F.col("_b") == F.col("_eb")
    for g, n in names.items():
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(n))
    rows = rows.join(edges, same)
    top = F.greatest("_carry", F.col("_top") - F.col("_before") * F.lit(step_us))
    moved = F.timestamp_micros(top + (F.col("_before") + F.col("_i")) * F.lit(step_us)).cast(df.schema[instant].dataType)
    return rows.withColumn(instant, moved).select(*df.columns).unionByName(df.where(F.col(instant).isNull()))
