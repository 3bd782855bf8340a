"""Rebuilding a table from a stream of inserts, updates and deletes.

Newest-first resolution: the log is split into batches by log position and processed backwards.
In each batch the newest change of a key wins; keys resolved by a newer batch are anti-joined
away; the first-seen image (or tombstone) of a key is recorded; base rows no change touched are
appended at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def change_events(log: DataFrame, key: str, op: str = "op", before: str = "before_row", after: str = "after_row", position: str = "source_lsn", ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per touched key: key, position, rank of ties, gone, image.

    c, r and u set the key of ``after``; d removes the key of ``before`` (of ``after`` if there is no
    before image); an update that changes the key also removes the old one.  At one position a set wins
    over a removal.  Changes without a usable key, and c, r, u without ``after``, say nothing and give no row.
    """
    b, a = F.col(before), F.col(after)
    none = F.lit(None).cast(log.schema[after].dataType)
    up = F.lower(F.col(op)).isin("c", "r", "u")
    one = lambda k, gone, image: F.struct(k.alias("key"), F.lit(gone).alias("gone"), image.alias("image"))
    parts = F.array(
        F.when(up & a[key].isNotNull(), one(a[key], False, a)),
        F.when(F.lower(F.col(op)) == "d", one(F.coalesce(b[key], a[key]), True, none)),
        F.when((F.lower(F.col(op)) == "u") & a[key].isNotNull() & b[key].isNotNull() & (a[key] != b[key]), one(b[key], True, none)),
    )
    events = log.select(F.col(position).alias("_at"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)], F.explode(parts).alias("e"))
    return events.select(F.col("e.key").alias("_key"), "_at", *[f"_t{i}" for i in range(len(ties))], F.col("e.gone").alias("_gone"), F.col("e.image").alias("_image")).where("_key IS NOT NULL")


def resolve(
    log: DataFrame, key: str, base: DataFrame | None = None, op: str = "op", before: str = "before_row", after: str = "after_row",
    position: str = "source_lsn", ties: tuple[str, ...] = ("transaction_order", "ts_ms", "topic_offset"), batches: int = 4,
) -> DataFrame:
    """The rows that exist after all changes, with ``position`` of the change that set them (null for base rows).

    ``position`` orders the changes; a repeated change keeps it, so repeats and arrival order do not matter;
    a null position counts as oldest.  ``base`` has the columns of the images; its rows stay where no change
    touches their key (repeats of base rows stay repeats).  Batch borders are approximate quantiles of
    ``position``: they only decide how the work is split.  An empty log gives the base; neither gives no rows.
    """
    events = change_events(log, key, op, before, after, position, ties)
    cuts = sorted(set(log.approxQuantile(position, [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    edges: list[float | None] = [None, *cuts, None]
    newest = F.struct("_at", ~F.col("_gone"), *[f"_t{i}" for i in range(len(ties))])
    resolved = None
    for i in reversed(range(len(edges) - 1)):
        low, high = edges[i], edges[i + 1]
        inside: Column = F.lit(True)
        if high is not None:
            inside = inside & (F.coalesce("_at", F.lit(-(2**63))) < F.lit(int(high)))
        if low is not None:
            inside = inside & (F.col("_at") >= F.lit(int(low)))
        batch = events.where(inside).groupBy("_key").agg(F.max_by(F.struct("_at", "_gone", "_image"), newest).alias("_last"))
        if resolved is not None:
            batch = batch.join(resolved, "_key", "left_anti")
        batch = batch.select("_key", "_last")
        resolved = cut(batch if resolved is None else resolved.unionByName(batch))
    live = resolved.where("NOT _last._gone").select("_last._image.*", F.col("_last._at").alias(position))
    if base is not None:
        rest = base.join(resolved.select(F.col("_key").alias(key)), key, "left_anti")
        live = live.unionByName(rest.withColumn(position, F.lit(None).cast(log.schema[position].dataType)), allowMissingColumns=True)
    return live


def tombstones(log: DataFrame, key: str, **how) -> DataFrame:
    """Keys whose newest change is a delete."""
    position = how.get("position", "source_lsn")
    events = change_events(log, key, **how)
    last = events.groupBy("_key").agg(F.max_by("_gone", F.struct("_at", ~F.col("_gone"))).alias("gone"), F.max("_at").alias(position))
    return last.where("gone").select(F.col("_key").alias(key), position)
