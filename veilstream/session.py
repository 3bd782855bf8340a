"""Session helpers: local sessions for tests, lineage cuts, skew-safe joins."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("veilstream")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever the driver was started.

    Adds the package's folder to the workers' path.  Executors on other machines need the package installed, or
    shipped with ``--py-files``.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), home) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder for lineage cuts and side tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only where neither that nor a
    checkpoint directory is set (tests, local mode) a temporary folder is set.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    jsc = sc._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    own = tempfile.mkdtemp(prefix="veilstream-")
    sc.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint (survives the loss of executors)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Hot keys that are looked after at most: what lies behind the list's broadcast.  A key beyond the list has less than
#: a ten-thousandth of all rows and is an ordinary one.
MOST_HOT = 10_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = 200_000, widest: int = 4096) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and ``_fan``, over how many salts theirs are to be spread.

    Counted with map-side combine, so a hot key reaches the reducers as one row per task.  The list has the
    ``MOST_HOT`` greatest at most, by a partial top-k; null keys are none.
    """
    counts = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    top = counts.orderBy(F.desc("_n"), *keys).limit(MOST_HOT)
    return top.select(*keys, F.least(F.ceil(F.col("_n") / hot_rows) * 2, F.lit(widest)).cast("bigint").alias("_fan"))


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str = "left", hot_rows: int = 200_000, hot: DataFrame | None = None
) -> DataFrame:
    """Equi-join (left, inner, left_semi or left_anti) in which the left rows of hot keys are spread by ``spread``.

    ``right`` rows of hot keys are repeated per salt.  ``hot`` (keys, _fan) may be given where it is known.  The
    list of hot keys is broadcast: it has at most ``MOST_HOT`` rows.  Null keys never match.
    """
    hot = F.broadcast(hot_keys(left, keys, hot_rows) if hot is None else hot)
    one = F.lit(0).cast("bigint")
    a = left.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_fan").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_fan"))).otherwise(one)).drop("_fan")
    b = right.join(hot, keys, "left").withColumn("_salt", F.explode(F.when(F.col("_fan").isNotNull(), F.sequence(one, F.col("_fan") - 1)).otherwise(F.array(one)))).drop("_fan")
    return a.join(b, [*keys, "_salt"], how).drop("_salt")
