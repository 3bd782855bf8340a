"""What deletes do to referring rows: cascade, set null, restrict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, hot_keys, salted_join

CASCADE, SET_NULL, RESTRICT = "cascade", "set null", "restrict"


class RestrictedDelete(ValueError):
    """A delete that a restricting reference forbids."""


@dataclass(frozen=True)
class Reference:
    child: str
    child_id: str
    field: str
    parent: str
    action: str


#: The references of the clinic's tables.
CLINIC = (
    Reference("appointments", "appointment_id", "patient_id", "patients", CASCADE),
    Reference("claims", "claim_id", "patient_id", "patients", CASCADE),
    Reference("notes", "note_id", "patient_id", "patients", CASCADE),
    Reference("appointments", "appointment_id", "provider_id", "providers", RESTRICT),
    Reference("notes", "note_id", "provider_id", "providers", RESTRICT),
    Reference("claims", "claim_id", "appointment_id", "appointments", CASCADE),
    Reference("notes", "note_id", "appointment_id", "appointments", SET_NULL),
    Reference("notes", "note_id", "amends_note_id", "notes", SET_NULL),
)


def consequences(tables: dict[str, DataFrame], references: tuple[Reference, ...], deletes: DataFrame, max_rounds: int = 50, hot_rows: int = 200_000) -> DataFrame:
    """table_name, row_id, op (D or U), field (what becomes null; '' for deletes), depth of all changes of a set of deletes.

    ``deletes`` has table_name and row_id.  Children are found by semi-joins, generation by generation, until a
    round deletes nothing new; a row is deleted once, at its least depth.  Rows that are deleted anyway are not
    set null.  A restricting reference from a row that stays raises RestrictedDelete.  Only what is asked for and
    what exists counts; null references refer to nothing.  Children of a parent with many are spread over tasks.
    """
    existing = None
    ids = {r.child: r.child_id for r in references}
    for name, df in tables.items():
        key = ids.get(name) or df.columns[0]
        one = df.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("row_id"))
        existing = one if existing is None else existing.unionByName(one)
    first = deletes.select("table_name", F.col("row_id").cast("bigint").alias("row_id")).distinct().join(existing, ["table_name", "row_id"], "left_semi")
    gone = cut(first.withColumn("depth", F.lit(0)))
    frontier = gone
    kids_of, hot = {}, {}
    for r in references:
        if r.child in tables:
            kids_of[r] = tables[r.child].select(F.col(r.child_id).cast("bigint").alias("row_id"), F.col(r.field).cast("bigint").alias("_ref"))
            hot[r] = cut(hot_keys(kids_of[r], ["_ref"], hot_rows))
    for depth in range(1, max_rounds + 1):
        found = None
        for r in references:
            if r.action == CASCADE and r.child in tables:
                up = frontier.where(F.col("table_name") == r.parent).select(F.col("row_id").alias("_ref"))
                kids = salted_join(kids_of[r], up, ["_ref"], F.col("row_id"), "left_semi", hot=hot[r])
                kids = kids.select(F.lit(r.child).alias("table_name"), "row_id")
                found = kids if found is None else found.unionByName(kids)
        if found is None:
            break
        frontier = cut(found.distinct().join(gone, ["table_name", "row_id"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        gone = cut(gone.unionByName(frontier))
    else:
        raise RuntimeError(f"the cascade did not end within {max_rounds} rounds")
    out = gone.select("table_name", "row_id", F.lit("D").alias("op"), F.lit("").alias("field"), "depth")
    for r in references:
        if r.action == CASCADE or r.child not in tables:
            continue
        up = gone.where(F.col("table_name") == r.parent).select(F.col("row_id").alias("_ref"), F.col("depth"))
        kids = salted_join(kids_of[r], up, ["_ref"], F.col("row_id"), "inner", hot=hot[r])
        kids = kids.withColumn("table_name", F.lit(r.child)).join(gone.select("table_name", "row_id"), ["table_name", "row_id"], "left_anti")
        kids = kids.groupBy("table_name", "row_id").agg((F.min("depth") + 1).alias("depth"))
        if r.action == RESTRICT:
            if not kids.isEmpty():
                raise RestrictedDelete(f"{r.child}.{r.field} still refers to deleted rows of {r.parent}")
            continue
        out = out.unionByName(kids.select("table_name", "row_id", F.lit("U").alias("op"), F.lit(r.field).alias("field"), "depth"))
    return out


def delete_all(tables: dict[str, DataFrame], references: tuple[Reference, ...]) -> DataFrame:
    """table_name, row_id, op (D), step: a delete for every row, tables that refer before those they refer to.

    Tables of one step do not refer to each other.  A table's references to itself do not count; other cycles
    raise ValueError.
    """
    left, step, steps = set(tables), 0, {}
    while left:
        free = {t for t in left if not any(r.parent == t and r.child in left and r.child != t for r in references)}
        if not free:
            raise ValueError(f"references in a circle: {', '.join(sorted(left))}")
        steps.update(dict.fromkeys(free, step))
        left, step = left - free, step + 1
    ids, out = {r.child: r.child_id for r in references}, None
    for name, df in tables.items():
        one = df.select(F.lit(name).alias("table_name"), F.col(ids.get(name) or df.columns[0]).cast("bigint").alias("row_id"), F.lit("D").alias("op"), F.lit(steps[name]).alias("step"))
        out = one if out is None else out.unionByName(one)
    return out


def refuse_truncates(envelopes: DataFrame, op: str = "op") -> DataFrame:
    """The envelopes; the first truncation (t) among them raises as it is read."""
    message = F.concat(F.lit("TruncateRefused: a truncation of "), F.coalesce(F.col("source.table") if "source" in envelopes.columns else F.lit(None).cast("string"), F.lit("a table")))
    return envelopes.withColumn(op, F.when(F.lower(F.col(op)) == "t", F.raise_error(message).cast("string")).otherwise(F.col(op)))
