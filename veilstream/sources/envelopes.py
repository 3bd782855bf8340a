"""Change envelopes as tables and files: their schema, building them, topics as folders of Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = T.StructType([
    T.StructField("version", T.StringType()), T.StructField("connector", T.StringType()), T.StructField("name", T.StringType()), T.StructField("ts_ms", T.LongType()),
    T.StructField("snapshot", T.StringType()), T.StructField("db", T.StringType()), T.StructField("sequence", T.StringType()), T.StructField("schema", T.StringType()),
    T.StructField("table", T.StringType()), T.StructField("txId", T.LongType()), T.StructField("lsn", T.LongType()), T.StructField("xmin", T.LongType()),
])
TRANSACTION = T.StructType([T.StructField("id", T.StringType()), T.StructField("total_order", T.LongType()), T.StructField("data_collection_order", T.LongType())])


def envelope_schema(row: T.StructType) -> T.StructType:
    """Schema of the envelopes of a row image, with where each came from (topic, partition, offset)."""
    return T.StructType([
        T.StructField("before", row), T.StructField("after", row), T.StructField("source", SOURCE), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("transaction", TRANSACTION), T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    ])


def envelopes(df: DataFrame, table: str, before: Column, after: Column, op: Column, at_ms: Column, offset: Column, tx: Column | None = None) -> DataFrame:
    """Envelopes of a table's changes, one per row of ``df``."""
    schema, name = table.split(".")
    n = F.lit(None)
    source = F.struct(
        F.lit("1").alias("version"), F.lit("postgresql").alias("connector"), F.lit("clinic").alias("name"), at_ms.cast("bigint").alias("ts_ms"), F.lit("false").alias("snapshot"), F.lit("clinic").alias("db"),
        n.cast("string").alias("sequence"), F.lit(schema).alias("schema"), F.lit(name).alias("table"), (tx if tx is not None else n).cast("bigint").alias("txId"), offset.cast("bigint").alias("lsn"), n.cast("bigint").alias("xmin"),
    )
    return df.select(
        before.alias("before"), after.alias("after"), source.alias("source"), op.alias("op"), at_ms.cast("bigint").alias("ts_ms"), F.lit(None).cast(TRANSACTION).alias("transaction"),
        F.lit(f"raw.{table}").alias("topic"), F.lit(0).alias("partition"), offset.cast("bigint").alias("offset"),
    )


def append_topic(df: DataFrame, path: str) -> None:
    """Append envelopes to a topic's folder, each with the time of its record: when the source committed it."""
    df.withColumn("record_ts", F.timestamp_millis("source.ts_ms")).write.mode("append").parquet(path)


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def missing_before_images(df: DataFrame) -> DataFrame:
    """Updates and deletes without the image from before, which full capture never has."""
    return df.where(F.lower("op").isin("u", "d") & F.col("before").isNull())
