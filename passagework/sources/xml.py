"""XML sources on Spark's own reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_BAD = "_passagework_bad_record"


def read_xml_rows(
    spark: SparkSession, path: str, tag: str = "row", columns: Sequence[str] | None = None, by_line: bool = False
) -> DataFrame:
    """One row per ``<tag>`` element, one string column per attribute.

    Without ``columns`` the columns are the union of all attributes, which costs a pass over the data.
    ``by_line`` reads files that hold one element per line in splits; otherwise a file is one split.
    Values stay strings: convert them with ``try_cast``, which gives null for bad ones. Malformed XML
    fails the job, since the reader cannot find its way back within a file; by line, it gives a row of
    nulls for the element.
    """
    reader = spark.read.format("xml").option("rowTag", tag).option("inferSchema", "false")
    # attribute values as they stand, and no column for text between the tags
    reader = reader.option("ignoreSurroundingSpaces", "false").option("valueTag", "inner")
    reader = reader.option("columnNameOfCorruptRecord", _BAD)
    if by_line:
        reader = reader.option("multiLine", "false")
    else:
        reader = reader.option("mode", "FAILFAST")
    if columns is not None:
        names = [f"_{c}" for c in columns] + [_BAD] * by_line
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in names]))
    df = reader.load(path)
    if by_line and _BAD in df.columns:
        # The lines around the elements (declaration, root tags) are not bad elements but none at all.
        df = df.where(F.col(_BAD).isNull() | F.col(_BAD).contains(f"<{tag}"))
    attributes = [c for c in df.columns if c.startswith("_") and c != _BAD]
    return df.select(*(F.col(f"`{c}`").alias(c[1:]) for c in attributes))


def read_xml_splits(
    spark: SparkSession, path: str, tag: str = "row", columns: Sequence[str] | None = None
) -> DataFrame:
    """``read_xml_rows`` for large files: one file is read by many tasks.

    Spark's text reader cuts a file at every ``<tag``, wherever its splits lie, so each record is the rest of one start tag
    and what follows it. The start tag alone is parsed, by Spark's XML functions. Malformed start tags fail the job. A
    comment or CDATA section that holds such a tag is not told apart from an element.
    """
    attribute = r"""\s+[\w:.\-]+\s*=\s*(?:"[^"<]*"|'[^'<]*')"""
    records = spark.read.option("lineSep", f"<{tag}").text(path)
    # what stands before a file's first element, and tags with longer names, are none
    records = records.where(F.col("value").rlike(r"^(?:\s+[^\s<]|\s*/?>)"))
    whole = F.regexp_extract("value", rf"^((?:{attribute})*)\s*/?>", 1)
    bad = F.raise_error(F.concat(F.lit("Malformed XML element: "), F.lit(f"<{tag}"), F.substr("value", F.lit(1), F.lit(200))))
    starts = records.select(F.when(F.col("value").rlike(rf"^(?:{attribute})*\s*/?>"), whole).otherwise(bad).alias("attributes"))
    if columns is None:
        name = F.regexp_extract_all("attributes", F.lit(r"""\s+([\w:.\-]+)\s*=\s*(?:"[^"<]*"|'[^'<]*')"""), F.lit(1))
        columns = sorted(r[0] for r in starts.select(F.explode(name)).distinct().collect())
    schema = ", ".join(f"`_{c}` string" for c in columns)
    options = {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false", "valueTag": "inner"}
    row = F.from_xml(F.concat(F.lit(f"<{tag}"), F.col("attributes"), F.lit("/>")), schema, options)
    parsed = starts.select(row.alias("row"))
    return parsed.select(*(F.col(f"row.`_{c}`").alias(c) for c in columns))


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """The addresses of a sitemap as ``url``."""
    schema = T.StructType([T.StructField("loc", T.StringType())])
    df = spark.read.format("xml").option("rowTag", "url").option("mode", "FAILFAST").schema(schema).load(path)
    return df.where(F.col("loc").isNotNull()).select(F.trim("loc").alias("url"))


def write_xml_rows(df: DataFrame, path: str, tag: str = "row", root: str = "posts") -> None:
    """Write every column as an attribute of ``<tag>``; nulls are left out."""
    attributes = df.select(*(F.col(c).cast("string").alias(f"_{c}") for c in df.columns))
    attributes.write.format("xml").option("rowTag", tag).option("rootTag", root).save(path)


def write_sitemap(urls: DataFrame, path: str) -> None:
    """Write a ``url`` column as a sitemap."""
    root = 'urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    urls.select(F.col("url").alias("loc")).write.format("xml").option("rowTag", "url").option("rootTag", root).save(path)
