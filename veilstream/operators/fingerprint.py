"""Fingerprints of tables that do not depend on row order, partitioning or surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import salted_join


def normal(c: Column, kind: T.DataType, scale: int = 2) -> Column:
    """A value as text: instants in UTC with microseconds, days as ISO, decimals with ``scale`` places, the rest as it is."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, T.DecimalType):
        return c.cast(T.DecimalType(38, scale)).cast("string")
    if isinstance(kind, T.ArrayType):
        return F.to_json(F.transform(c, lambda x: normal(x, kind.elementType, scale)))
    if isinstance(kind, T.StructType):
        names = sorted(f.name for f in kind.fields)
        return F.to_json(F.struct(*[normal(c[n], kind[n].dataType, scale).alias(n) for n in names]))
    if isinstance(kind, T.MapType):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c))))
    return c.cast("string")


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of a row's values by column name in alphabetical order; null and text never meet."""
    names = sorted(columns or df.columns)
    parts = [F.coalesce(F.concat(F.lit(f"{n}="), F.length(v := normal(F.col(f"`{n}`"), df.schema[n].dataType)).cast("string"), F.lit(":"), v), F.lit(f"{n}~")) for n in names]
    return F.sha2(F.concat_ws("\x1e", *parts), 256)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: n_rows and digest.

    The digest is the sum of all rows' hashes (their first 60 bits, four times over different 15 digits), so it
    is one partial aggregation at any size, and repeated rows count.  An empty table has the digest of zero.
    """
    hashes = df.select(row_hash(df, columns).alias("h"))
    sums = [F.coalesce(F.sum(F.conv(F.substring("h", 15 * i + 1, 15), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string") for i in range(4)]
    return hashes.agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(reduce(lambda a, b: F.concat(a, F.lit(":"), b), sums), 256).alias("digest"))


def natural(df: DataFrame, lookups: list[tuple[str, DataFrame, str, Column, str]], drop: list[str] = ()) -> DataFrame:
    """The table with surrogate keys replaced by natural ones.

    Each lookup is (column, other table, its key, natural key of it, new name); a null or unknown reference gives
    null; of repeated rows of the other table the least natural key counts.  ``drop`` names further surrogate columns to leave out.
    """
    for column, other, key, value, name in lookups:
        known = other.select(F.col(key).alias("_key"), value.alias(name)).where("_key IS NOT NULL").groupBy("_key").agg(F.min(name).alias(name))
        spread = F.xxhash64(*[c for c in df.columns if c != column]) if len(df.columns) > 1 else F.rand(7)
        df = salted_join(df.withColumn("_key", F.col(f"`{column}`")), known, ["_key"], spread).drop("_key", column)
    return df.drop(*drop)


def clinic(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The clinic's tables without surrogate keys: a patient is its mrn, a provider its npi, a visit mrn@scheduled_at, a note mrn@authored_at."""
    mrn = ("patient_id", tables["patients"], "patient_id", F.col("mrn"), "patient")
    npi = ("provider_id", tables["providers"], "provider_id", F.col("npi"), "provider")
    text = lambda df, c: normal(F.col(c), df.schema[c].dataType)
    named = {}
    for table, key, at in (("appointments", "appointment_id", "scheduled_at"), ("notes", "note_id", "authored_at")):
        df = tables[table].select(key, "patient_id", text(tables[table], at).alias("_at"))
        named[table] = natural(df, [mrn]).select(key, F.concat_ws("@", "patient", "_at").alias("_name"))
    visit = ("appointment_id", named["appointments"], "appointment_id", F.col("_name"), "visit")
    amends = ("amends_note_id", named["notes"], "note_id", F.col("_name"), "amends")
    return {
        "providers": tables["providers"].drop("provider_id"), "patients": tables["patients"].drop("patient_id"), "appointments": natural(tables["appointments"], [mrn, npi], ["appointment_id"]),
        "claims": natural(tables["claims"], [mrn, visit], ["claim_id"]), "notes": natural(tables["notes"], [mrn, npi, visit, amends], ["note_id"]),
    }


def database(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n_rows, digest of each table, and of all of them together ('*'), which is a hash over the tables' digests by name."""
    each = None
    for name, df in sorted(tables.items()):
        one = fingerprint(df).select(F.lit(name).alias("table_name"), "n_rows", "digest")
        each = one if each is None else each.unionByName(one)
    line = F.concat_ws(":", "table_name", F.col("n_rows").cast("string"), "digest")
    whole = each.agg(F.sum("n_rows").alias("n_rows"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"))
    return each.unionByName(whole.select(F.lit("*").alias("table_name"), "n_rows", "digest"))
