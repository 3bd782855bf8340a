"""All queries outside the llm subpackage, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import drifting, flow, masking, repair, timeline

QUERIES = {**repair.QUERIES, **drifting.QUERIES, **masking.QUERIES, **timeline.QUERIES, **flow.QUERIES}
SQL = {**repair.SQL, **drifting.SQL, **masking.SQL, **timeline.SQL, **flow.SQL}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return masking.token_join_revenue(spark, folder)
