"""Table sources: datasets by kind, named tables, bounded reads, payloads of addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.sources.xml import read_sitemap, read_xml_splits


# Rows of one address that a task makes copies for.
COPIES = 10_000


def read_parquet(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """A parquet dataset.

    ``spread_by`` names the key to spread a small input by: only if the files give fewer splits than
    the session has cores, rows are placed by that key, so that the work after the scan uses all of
    them. A large dataset has splits enough and is not shuffled.
    """
    df = spark.read.parquet(path)
    if spread_by is not None:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores, spread_by)
    return df


def from_values(spark: SparkSession, values: Sequence[str], column: str = "url") -> DataFrame:
    """A one-column string table from driver-side values."""
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def first_n(df: DataFrame, n: int | None, *order: str | Column) -> DataFrame:
    """The first ``n`` rows by ``order``, or all rows for ``None``. Files have no order, so one is needed."""
    if n is None:
        return df
    if not order:
        raise ValueError("the first n rows need an order")
    return df.orderBy(*order).limit(n)


def pick_split(df: DataFrame, split: str, n: int | None, *order: str | Column, column: str = "split") -> DataFrame:
    """Rows of one split of a dataset, bounded by ``first_n``."""
    return first_n(df.where(F.col(column) == split), n, *order)


def attach_payload(
    addresses: DataFrame, landing: DataFrame, key: str = "url", payload: str = "html", status: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Every address with its landed payload; null if it was not landed or its status is not 200.

    ``landing`` has one row per address (see ``latest_per_key``); binary payloads are decoded. An
    address may occur any number of times. A list of addresses alone is first reduced to the different ones and their numbers;
    if ``landing`` is a table with that many ``buckets`` by ``key``, its payloads are then joined where they lie. Addresses with more than
    ``COPIES`` rows are dealt out in portions of that many, so their copies are made by many tasks.
    """
    body = F.col(payload)
    if dict(landing.dtypes)[payload] == "binary":
        body = F.decode(body, "UTF-8")
    if status is not None:
        body = F.when(F.col(status) == 200, body)
    landed = landing.select(key, body.alias(payload))
    if addresses.columns != [key]:
        return addresses.join(landed, key, "left")
    counted = addresses.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    if buckets is not None:
        counted = counted.repartition(buckets, key)
    met = counted.join(landed, key, "left").select(key, payload, "__n")

    def copies(rows: DataFrame, n: Column) -> DataFrame:
        return rows.select(key, payload, F.explode(F.sequence(F.lit(1), n))).select(key, payload)

    many = met.where(F.col("__n") > COPIES)
    portions = F.explode(F.sequence(F.lit(0), F.ceil(F.col("__n") / COPIES) - 1))
    many = many.select(key, payload, "__n", portions.alias("__portion")).repartition(F.col(key), F.col("__portion"))
    return copies(met.where(F.col("__n") <= COPIES), F.col("__n")).unionByName(
        copies(many, F.least(F.lit(COPIES).cast("bigint"), F.col("__n") - F.col("__portion") * COPIES))
    )


def load_dataset(
    spark: SparkSession, kind: str, path: str, limit: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Open a dataset by kind; the limit holds for every kind.

    Kinds: ``pages`` (parquet, by url), ``posts`` (XML attribute rows, by Id), ``sitemap`` (XML, by url).
    """
    if kind == "pages":
        return first_n(spark.read.parquet(path), limit, "url")
    if kind == "posts":
        rows = read_xml_splits(spark, path, columns=columns)
        return first_n(rows, limit, F.col("Id").try_cast("bigint"), "Id")
    if kind == "sitemap":
        return first_n(read_sitemap(spark, path), limit, "url")
    raise ValueError(f"unknown dataset kind {kind!r}")
