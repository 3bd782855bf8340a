"""The newest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """One row per key, the greatest by ``order`` (nulls lowest; ties by the row's own values).

    An aggregate with map-side combine, so no sort and no window over a hot key.
    """
    names = [c for c in (columns or df.columns) if c not in keys]
    picked = F.max_by(F.struct(*names), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.xxhash64(*names).alias("tie")))
    return df.groupBy(*keys).agg(picked.alias("_row")).select(*keys, "_row.*")
