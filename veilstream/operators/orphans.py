"""References to records that do not exist: direct orphans and those that inherit it.

Direct orphans come from a join of every reference with its parent's state.  The cascade is a
fixpoint: children of orphaned records are orphaned too, found by semi-joins of the frontier
down the foreign-key graph until a round finds nothing new.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, hot_keys, salted_join


@dataclass(frozen=True)
class ForeignKey:
    child: str
    child_id: str
    field: str
    parent: str
    parent_id: str


def parent_states(tables: dict[str, DataFrame], keys: list[ForeignKey], deletions: DataFrame | None, loaded: str) -> DataFrame:
    """One row per (parent table, key): when it first reached us (null if never) and whether it is logged as deleted."""
    states = None
    for table, key in sorted({(k.parent, k.parent_id) for k in keys}):
        own = tables[table].select(
            F.lit(table).alias("parent_table"), F.col(key).cast("bigint").alias("ref_id"), F.lit(True).alias("here"), F.col(loaded).cast("timestamp").alias("parent_loaded"), F.lit(False).alias("deleted")
        )
        states = own if states is None else states.unionByName(own)
    if deletions is not None:
        name = F.regexp_replace(F.lower(F.trim("source_table")), r"^.*\.", "")
        gone = deletions.select(
            name.alias("parent_table"), F.col("row_id").cast("bigint").alias("ref_id"), F.lit(False).alias("here"), F.lit(None).cast("timestamp").alias("parent_loaded"), F.lit(True).alias("deleted")
        )
        states = states.unionByName(gone)
    return (
        states.where("ref_id IS NOT NULL")
        .groupBy("parent_table", "ref_id")
        .agg(F.max("here").alias("here"), F.min("parent_loaded").alias("parent_loaded"), F.max("deleted").alias("deleted"))
    )


def _labelled(column: str, key: ForeignKey) -> Column:
    return F.transform(column, lambda x: F.struct(F.lit(key.field).alias("ref_field"), F.lit(key.parent).alias("parent_table"), x.alias("ref_id")))


def references(tables: dict[str, DataFrame], keys: list[ForeignKey], loaded: str) -> DataFrame:
    """One row per (child table, field, child id, referred key) with the child's earliest load.

    Re-delivered rows and older versions of a child collapse in one partial aggregation per table.
    """
    out = None
    for child, child_id in sorted({(k.child, k.child_id) for k in keys}):
        own = [k for k in keys if k.child == child]
        df = tables[child].select(F.col(child_id).cast("bigint").alias("child_id"), F.col(loaded).cast("timestamp").alias("_loaded"), *[F.col(k.field).cast("bigint").alias(f"_r{i}") for i, k in enumerate(own)])
        df = df.where("child_id IS NOT NULL").groupBy("child_id").agg(
            F.min("_loaded").alias("child_loaded"), *[F.collect_set(f"_r{i}").alias(f"_r{i}") for i in range(len(own))]
        )
        rows = F.flatten(F.array(*[_labelled(f"_r{i}", k) for i, k in enumerate(own)]))
        df = df.select(F.lit(child).alias("child_table"), "child_id", "child_loaded", F.explode(rows).alias("r")).select("child_table", "child_id", "child_loaded", "r.*")
        out = df if out is None else out.unionByName(df)
    return out


def orphans(tables: dict[str, DataFrame], keys: list[ForeignKey], deletions: DataFrame | None = None, loaded: str = "loaded_at", max_rounds: int = 50, hot_rows: int = 200_000) -> DataFrame:
    """child_table, ref_field, child_id, ref_id, orphan_kind, load_month, lineage (direct or inherited), round.

    orphan_kind of a direct orphan: ``deleted`` if the log of deletions names the absent key, ``missing``
    if not, ``late`` if the key came after the child.  ``inherited`` rows refer to an existing record that
    is itself an orphan (missing or deleted, directly or by inheritance); late parents are no loss and
    pass nothing on.  Null references and children without an id are no references.  A child whose
    versions refer to several keys is judged for each; the row says which.  Cycles end, as a reference is
    reported once.  ``max_rounds`` only guards against endless loops and raises when it is reached.
    """
    refs = references(tables, keys, loaded)
    states = parent_states(tables, keys, deletions, loaded)
    refs = cut(refs)
    hot = cut(hot_keys(refs, ["parent_table", "ref_id"], hot_rows))
    refs = cut(salted_join(refs, states, ["parent_table", "ref_id"], F.col("child_id"), "left", hot=hot))
    here = F.coalesce("here", F.lit(False))
    kind = (
        F.when(~here & F.coalesce("deleted", F.lit(False)), "deleted")
        .when(~here, "missing")
        .when(F.col("parent_loaded") > F.col("child_loaded"), "late")
    )
    refs = refs.withColumn("orphan_kind", kind).withColumn("load_month", F.date_format("child_loaded", "yyyy-MM")).drop("here", "deleted", "parent_loaded", "child_loaded")
    found = refs.where("orphan_kind IS NOT NULL").withColumn("lineage", F.lit("direct")).withColumn("round", F.lit(0))
    parents = {k.parent for k in keys}
    frontier = found.where(F.col("orphan_kind") != "late").where(F.col("child_table").isin(*parents)).select(F.col("child_table").alias("parent_table"), F.col("child_id").alias("ref_id")).distinct()
    frontier = cut(frontier)
    known = frontier
    calm = refs.where("orphan_kind IS NULL OR orphan_kind = 'late'")
    for step in range(1, max_rounds + 1):
        if frontier.isEmpty():
            return found
        heirs = salted_join(calm, frontier, ["parent_table", "ref_id"], F.col("child_id"), "left_semi", hot=hot)
        heirs = heirs.withColumn("orphan_kind", F.lit("inherited")).withColumn("lineage", F.lit("inherited")).withColumn("round", F.lit(step))
        found = found.unionByName(heirs)
        fresh = heirs.where(F.col("child_table").isin(*parents)).select(F.col("child_table").alias("parent_table"), F.col("child_id").alias("ref_id")).distinct()
        frontier = cut(fresh.join(known, ["parent_table", "ref_id"], "left_anti"))
        known = cut(known.unionByName(frontier))
    if not frontier.isEmpty():
        raise RuntimeError(f"the foreign-key cascade did not end within {max_rounds} rounds")
    return found


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphan references per child table, field, kind, month and lineage."""
    return found.groupBy("child_table", "ref_field", "orphan_kind", "load_month", "lineage").agg(F.count(F.lit(1)).alias("n_refs"), F.count_distinct("ref_id").alias("n_keys"))
