"""Namespaces, views and managed or external tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.functions.text import namespace_part


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def current_namespace(spark: SparkSession, prefix: str = "") -> str:
    """A schema name for the session's user: ``prefix`` and the user's name before a dot or at sign."""
    row = spark.range(1).select(namespace_part(F.current_user()).alias("part")).first()
    return prefix + re.sub(r"\W", "_", row["part"])


def ensure_schema(spark: SparkSession, schema: str, use: bool = False, location: str | None = None) -> None:
    """Create a schema unless it exists, its managed tables below ``location`` if given, and select it if asked to."""
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}{place}")
    if use:
        spark.catalog.setCurrentDatabase(schema)


def publish_view(df: DataFrame, name: str) -> None:
    """Give a DataFrame a name for SQL in this session."""
    df.createOrReplaceTempView(name)


def overwrite_table(
    df: DataFrame, name: str, path: str | None = None, bucket_by: str | None = None, buckets: int = 0
) -> DataFrame:
    """Replace a table's content and open it.

    With ``bucket_by`` later joins and aggregations on that column need no shuffle. A table cannot be
    read and replaced by the same job; write a staged table in between.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if bucket_by is not None:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
