"""Top-k and latest-record selection that survives a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark plans a per-partition group limit before the shuffle only up to this rank
# (the default of spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT_RANK = 1000


def top_k(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rk", salts: int = 64, wide: bool = False
) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their rank as an int column.

    ``order`` must be total within a key. For a small ``k`` Spark itself keeps at most ``k`` rows per
    key and partition before the shuffle. For a larger one the same is done over salted keys first,
    so no task ever sorts a whole hot key. ``wide`` asks for the salted step at any ``k``: with very
    many partitions even ``k`` rows of each are much for one task.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if wide or k > GROUP_LIMIT_RANK:
        columns = df.columns
        # The partition takes part, so that even exact copies of one row are spread.
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), F.lit(salts)))
        part = Window.partitionBy(*keys, "__salt").orderBy(*order)
        df = salted.withColumn("__rn", F.row_number().over(part)).where(F.col("__rn") <= k).select(*columns)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def latest_per_key(df: DataFrame, keys: list[str], time: str, tie: list[str]) -> DataFrame:
    """The newest row of each key; equal times are decided by the ``tie`` columns, largest first."""
    order = [F.col(c).desc_nulls_last() for c in (time, *tie)]
    return top_k(df, keys, order, 1, rank="__rk").drop("__rk")


def latest(df: DataFrame, time: str, tie: list[str]) -> DataFrame:
    """The single newest row of a table."""
    return df.orderBy(*(F.col(c).desc_nulls_last() for c in (time, *tie))).limit(1)
