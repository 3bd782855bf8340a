"""Applying clean changes to a table kept as a base and deltas of Parquet.

A batch writes the newest change of each of its keys as a delta and reads nothing; a reader takes the newest
version of a key over the base and the deltas after it.  Every ``compact`` batches the deltas are folded into a
new base, and what lies before the base before is removed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str, kind: str = "v") -> list[int]:
    """Batches whose base (``v``) or delta (``d``) was written completely, oldest first."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    out, done = [], spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for s in fs.listStatus(p):
        m = re.match(rf"{kind}(\d+)$", s.getPath().getName())
        if m and fs.exists(done(s.getPath(), "_SUCCESS")):
            out.append(int(m[1]))
    return sorted(out)


def state(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    """Newest version of each key (tombstones too) over the newest base and the deltas after it; None before the first batch.

    With ``upto``: over the newest base before that batch and the deltas up to it.
    """
    bases = [v for v in versions(spark, path) if upto is None or v < upto]
    deltas = [d for d in versions(spark, path, "d") if (upto is None or d <= upto) and (not bases or d > bases[-1])]
    parts = [f"{path}/v{v}" for v in bases[-1:]] + [f"{path}/d{d}" for d in deltas]
    if not parts:
        return None
    rows = spark.read.parquet(*parts)
    if len(parts) == 1:
        return rows
    keys = [c for c in rows.columns if not c.startswith("_")]
    return newest(rows, keys)


def newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(F.struct("_image", "_gone", "_at"), "_at").alias("_row")).select(*keys, "_row.*")


def newest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Of a batch of changes: key columns, _image, _gone, _at of the newest change of each key.

    Tombstones stay in the state, so that a change that arrives late cannot bring a deleted row back.
    """
    image = F.coalesce("after", "before")
    new = changes.where(image.isNotNull()).select(
        *[image[k].alias(k) for k in keys], F.col("after").alias("_image"), (F.lower("op") == "d").alias("_gone"), F.struct(F.coalesce("source.lsn", "offset").alias("lsn"), F.col("offset").alias("offset")).alias("_at")
    )
    return newest(new, keys)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows that exist; None before the first batch."""
    rows = state(spark, path)
    return None if rows is None else rows.where("NOT _gone").select("_image.*")


def compact_until(spark: SparkSession, path: str, number: int) -> None:
    """Fold all before batch ``number`` and it into base ``number``; older bases and deltas go, but for one base and what follows it.

    Readers that began before keep their files for one compaction.
    """
    rows = state(spark, path, number)
    if rows is not None:
        rows.write.mode("overwrite").parquet(f"{path}/v{number}")
    bases = versions(spark, path)
    keep = bases[-2] if len(bases) > 1 else None
    fs, _ = _folder(spark, path)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for kind in ("v", "d"):
        for n in versions(spark, path, kind):
            if keep is not None and (n < keep or kind == "d" and n == keep):
                fs.delete(make(f"{path}/{kind}{n}"), True)


def start(changes: DataFrame, path: str, keys: list[str], checkpoint: str, compact: int = 20) -> StreamingQuery:
    """Apply a stream of clean envelopes.  A batch that is run again overwrites its own delta."""

    def batch(df: DataFrame, number: int) -> None:
        newest_changes(df, keys).write.mode("overwrite").parquet(f"{path}/d{number}")
        if number % compact == compact - 1:
            compact_until(df.sparkSession, path, number)

    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
