"""Applying a policy to tables and to change envelopes: one projection, batch or streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keyed import Kernel, Keys, signed_draw, token
from ..operators.deid import Built
from . import avro
from .policy import Policy
from .schema import SchemaError, plan_row, plan_table

def _draw(b: Built, kernel: Kernel, anchor: Column | None, kinds: dict[str, T.DataType]) -> Column | None:
    """The draw of an anchored operation; operations with one purpose and anchor share its digest."""
    if b.anchor is None:
        return None
    return signed_draw(kernel.anchor_digest(b.rule.op.name, anchor, kinds[b.anchor]), 0, b.span)


def clean_table(df: DataFrame, policy: Policy, table: str, keys: Keys, unicode: bool = True) -> DataFrame:
    """The table with each column changed by its rule, in the table's order.

    Dropped columns are not even read.  Anchors are read from the raw row.  Columns without a rule halt or go,
    as the policy says.
    """
    plan = plan_table(df.schema, policy, table, keys)
    kernel = Kernel(df.sparkSession, keys, unicode)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    raw = lambda c: F.col(f"`{c}`")
    out = [
        b.apply(kernel, raw(b.rule.column), _draw(b, kernel, raw(b.anchor), kinds) if b.anchor else None).alias(b.rule.column, metadata=avro.declared(b.clean))
        for b in plan.kept
    ]
    return kernel.attach(df).select(*out)


def clean_envelope(df: DataFrame, policy: Policy, table: str, keys: Keys, unicode: bool = True) -> DataFrame:
    """Envelopes with before and after changed by the policy; source, op, ts_ms and all else as they were.

    before and after are changed independently, each by its own anchor, so deletes work like inserts.
    """
    images = {f.name: f.dataType for f in df.schema.fields if f.name in ("before", "after")}
    if images.keys() != {"before", "after"} or not all(isinstance(t, T.StructType) for t in images.values()):
        raise SchemaError("an envelope has the structs before and after")
    if [(f.name, f.dataType) for f in images["before"].fields] != [(f.name, f.dataType) for f in images["after"].fields]:
        raise SchemaError("before and after are different records")
    plan = plan_row([{"name": f.name, "type": avro.avro_type(f)} for f in images["after"].fields], policy, table, keys)
    kernel = Kernel(df.sparkSession, keys, unicode)
    kinds = {f.name: f.dataType for f in images["after"].fields}
    sides = {}
    for side in ("before", "after"):
        image = F.col(side)
        fields = [b.apply(kernel, image[b.rule.column], _draw(b, kernel, image[b.anchor], kinds) if b.anchor else None).alias(b.rule.column) for b in plan.kept]
        sides[side] = F.when(image.isNotNull(), F.struct(*fields)).alias(side)
    return kernel.attach(df).select(*[sides.get(c, F.col(f"`{c}`")) for c in df.columns])


def clean_key(df: DataFrame, column: str, domain: str, keys: Keys, unicode: bool = True) -> DataFrame:
    """A record key hashed under its primary key's domain, so that it still finds its row."""
    kernel = Kernel(df.sparkSession, keys, unicode)
    clean = token(kernel.digest("hmac:" + domain, kernel.canonical(F.col(column), df.schema[column].dataType)))
    return kernel.attach(df).select(*[clean.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


def required_violations(df: DataFrame) -> dict[str, int]:
    """Nulls per column that is declared to have none (metadata ``required``); empty when the contract holds."""
    must = [f.name for f in df.schema.fields if f.metadata.get("required")]
    if not must:
        return {}
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in must]).first()
    return {c: row[c] for c in must if row[c]}
