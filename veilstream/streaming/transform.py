"""Raw topics to clean topics, one streaming query a table, so that a table that halts stops no other."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.keyed import Keys
from ..plans.policy import Policy
from ..plans.transform import clean_envelope


@dataclass
class Running:
    """What was started, and why the rest was not."""

    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    halted: dict[str, Exception] = field(default_factory=dict)

    def finish(self) -> Running:
        """Wait until all that is there has been processed; tables that fail on the way are halted."""
        for name, q in list(self.queries.items()):
            try:
                q.awaitTermination()
            except Exception as e:  # noqa: BLE001  (a failed stream halts its table only)
                self.halted[name] = e
        return self


def clean_stream(spark: SparkSession, path: str, schema: T.StructType, policy: Policy, table: str, keys: Keys, unicode: bool = True) -> DataFrame:
    """The clean envelopes of a raw topic as a stream: the batch projection over a file source, without state."""
    raw = spark.readStream.schema(schema).parquet(path)
    clean = clean_envelope(raw, policy, table, keys, unicode)
    return clean.withColumn("topic", F.regexp_replace("topic", "^raw\\.", "clean."))


def start(spark: SparkSession, policy: Policy, topics: dict[str, tuple[str, T.StructType]], out: str, keys: Keys, unicode: bool = True) -> Running:
    """Start a query for each table (name: raw path and envelope schema) that writes to ``out``/clean/<table>.

    Every plan is bound before its query starts: a table whose policy does not fit is recorded as halted and the
    others run.  Checkpoints lie under ``out``/checkpoints; a restart goes on where it stopped, and the file sink
    writes every envelope once.
    """
    running = Running()
    for table, (path, schema) in topics.items():
        try:
            clean = clean_stream(spark, path, schema, policy, table, keys, unicode)
            writer = clean.writeStream.format("parquet").option("path", f"{out}/clean/{table}").option("checkpointLocation", f"{out}/checkpoints/{table}")
            running.queries[table] = writer.outputMode("append").trigger(availableNow=True).start()
        except Exception as e:  # noqa: BLE001  (whatever is wrong with one table must not stop the others)
            running.halted[table] = e
    return running
