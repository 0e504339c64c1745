"""Incremental form of the page ingest: the same stateless steps on newly landed files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from passagework.plans.ingest import page_chunks


def stream_page_chunks(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    keep: list[str],
    files: str = "*.parquet",
    **options,
) -> StreamingQuery:
    """Append the chunks of page files new in ``landing`` since the last run to ``out``, then stop.

    ``files`` selects the folder's files by name; ``options`` are those of ``page_chunks``.
    """
    pages = spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(landing)
    return (
        page_chunks(pages, keep, **options)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
