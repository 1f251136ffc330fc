"""SQL query as a job's input (S11): the query text runs over registered views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def sql_source(spark: SparkSession, query: str, views: Mapping[str, str | DataFrame] | None = None) -> DataFrame:
    """Register ``views`` (name -> parquet path or DataFrame) and run ``query``.

    Catalyst plans the query against the views, so filters and projections
    reach the scans.
    """
    for name, src in (views or {}).items():
        df = spark.read.parquet(src) if isinstance(src, str) else src
        df.createOrReplaceTempView(name)
    return spark.sql(query)
