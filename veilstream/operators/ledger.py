"""Point in time: replaying a ledger, checking it, cutting a log at an instant or a transaction."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import neighbour


class OutsideWindow(ValueError):
    """A point in time of which nothing is known: before the capture of changes began, or after what was captured last."""


def guard(at, captured_from, captured_to=None) -> None:
    """Raise if nothing is known about ``at``.  Both edges are known."""
    if at < captured_from:
        raise OutsideWindow(f"{at} lies before {captured_from}, when the capture of changes began")
    if captured_to is not None and at > captured_to:
        raise OutsideWindow(f"{at} lies after {captured_to}, the last that was captured")


def replay(ledger: DataFrame, keys: list[str], values: list[str], at: datetime | Column | None = None, op: str = "op", instant: str = "tx_at", sequence: str = "history_id") -> DataFrame:
    """The rows that exist at ``at`` (inclusive; the end of the ledger if None): keys and values.

    The newest entry of a key wins (ties of the instant by ``sequence``); a key whose newest entry is a delete
    (D or d) is absent.  One aggregation with map-side combine: no sort, and a hot key moves one row a task.
    Rows with a null instant never happened; null keys are a key.
    """
    if at is not None:
        ledger = ledger.where(F.col(instant) <= (at if isinstance(at, Column) else F.lit(at)))
    newest = F.max_by(F.struct(F.col(op).alias("_op"), *values), F.struct(instant, sequence))
    state = ledger.where(F.col(instant).isNotNull()).groupBy(*keys).agg(newest.alias("_row"))
    return state.where(F.upper("_row._op") != "D").select(*keys, *[F.col(f"_row.{v}").alias(v) for v in values])


def difference(replayed: DataFrame, live: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, as multisets, with the ``side`` that has them; empty when they agree."""
    live = live.select(*replayed.columns)
    return replayed.exceptAll(live).withColumn("side", F.lit("ledger")).unionByName(live.exceptAll(replayed).withColumn("side", F.lit("live")))


def inversions(ledger: DataFrame, instant: str = "tx_at", sequence: str = "history_id", stretch: int = 20) -> DataFrame:
    """Entries whose instant lies before that of the entry before them; empty for an append-only ledger.

    The neighbour is found in stretches of 2^``stretch`` sequence numbers with one carried row each, so the
    global order needs no single partition.
    """
    rows = ledger.select(sequence, instant)
    seen = neighbour(rows, [], F.shiftright(sequence, stretch), [sequence], [instant], "_before")
    return seen.where(F.col(f"_before.{instant}") > F.col(instant)).select(sequence, instant, F.col(f"_before.{instant}").alias("previous"))


def split_transactions(ledger: DataFrame, tx: str = "txid", instant: str = "tx_at") -> DataFrame:
    """Transactions with more than one instant."""
    return ledger.groupBy(tx).agg(F.count_distinct(instant).alias("n_instants")).where("n_instants > 1")


def shared_instants(ledger: DataFrame, tx: str = "txid", instant: str = "tx_at") -> DataFrame:
    """Instants that more than one transaction has."""
    return ledger.groupBy(instant).agg(F.count_distinct(tx).alias("n_transactions")).where("n_transactions > 1")


def wide_transactions(ledger: DataFrame, tx: str = "txid", table: str = "table_name") -> DataFrame:
    """Transactions that touch more than one table."""
    return ledger.groupBy(tx).agg(F.count_distinct(table).alias("n_tables"), F.count(F.lit(1)).alias("n_entries")).where("n_tables > 1")


def summary(ledger: DataFrame, tx: str = "txid", instant: str = "tx_at", table: str = "table_name") -> DataFrame:
    """Entries by table and operation with their transactions, instants and span."""
    return ledger.groupBy(table, "op").agg(
        F.count(F.lit(1)).alias("n_entries"), F.count_distinct(tx).alias("n_transactions"), F.count_distinct(instant).alias("n_instants"), F.min(instant).alias("first_at"), F.max(instant).alias("last_at")
    )


def late_arrivals(ledger: DataFrame, key: list[str], instant: str = "tx_at", sequence: str = "history_id", stretch: int = 20) -> DataFrame:
    """Per key, entries that arrive after an entry with a later instant."""
    seen = neighbour(ledger.select(*key, sequence, instant), key, F.shiftright(sequence, stretch), [sequence], [instant], "_before")
    return seen.groupBy(*key).agg(F.count_if(F.col(f"_before.{instant}") > F.col(instant)).alias("n_late")).where("n_late > 0")


# --- logs ---------------------------------------------------------------------------------------------


def manifest(log: DataFrame, at_ms: int, topic: str = "topic", partition: str = "partition", offset: str = "offset", ts: str = "ts_ms") -> DataFrame:
    """topic, partition, cut_offset: where to stop to see everything at or before ``at_ms``.

    The cut is the earliest offset whose time is later (that is, at_ms + 1 or more), or the end of the partition;
    a prefix [0, cut) then agrees with a replay at ``at_ms`` as long as times rise along offsets.
    """
    later = F.min(F.when(F.col(ts) > at_ms, F.col(offset)))
    return log.groupBy(topic, partition).agg(F.coalesce(later, F.max(offset) + 1).alias("cut_offset"))


def inside(log: DataFrame, cuts: DataFrame, topic: str = "topic", partition: str = "partition", offset: str = "offset") -> DataFrame:
    """The records before the cut of their partition.  ``cuts`` has a row a partition."""
    return log.join(cuts, [topic, partition]).where(F.col(offset) < F.col("cut_offset")).drop("cut_offset")


def snap_to_transactions(log: DataFrame, cuts: DataFrame, tx: str = "txid", topic: str = "topic", partition: str = "partition", offset: str = "offset") -> DataFrame:
    """The records of those transactions that lie wholly before the cuts; records without a transaction stand alone."""
    marked = log.join(cuts, [topic, partition]).withColumn("_in", F.col(offset) < F.col("cut_offset"))
    whole = marked.where(F.col(tx).isNotNull()).groupBy(tx).agg(F.min("_in").alias("_whole")).where("_whole").select(tx)
    kept = marked.where("_in").drop("_in", "cut_offset")
    alone = kept.where(F.col(tx).isNull())
    return kept.join(whole, tx, "left_semi").select(*log.columns).unionByName(alone.select(*log.columns))


def restore(
    log: DataFrame, at_ms: int, captured_from_ms: int, captured_to_ms: int | None, keys: list[str], values: list[str], tx: str = "txid", op: str = "op",
    topic: str = "topic", partition: str = "partition", offset: str = "offset", ts: str = "ts_ms",
) -> DataFrame:
    """The state at ``at_ms`` from a log of changes: guarded, cut by a manifest, snapped to whole transactions, replayed.

    ``at_ms`` itself counts.  The newest change of a key by time and offset wins; deleted keys are absent.
    """
    guard(at_ms, captured_from_ms, captured_to_ms)
    kept = snap_to_transactions(log, manifest(log, at_ms, topic, partition, offset, ts), tx, topic, partition, offset)
    return replay(kept, keys, values, None, op, ts, offset)


def write_restored(state: DataFrame, path: str, at_ms: int) -> None:
    """Write one restored state; states of other points in time under ``path`` stay, this one is replaced."""
    state.write.mode("overwrite").parquet(f"{path.rstrip('/')}/at_ms={int(at_ms)}")
