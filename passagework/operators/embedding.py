"""Text to vectors.

The built-in vectors are hashed TF-IDF weights, a deterministic offline stand-in for a sentence model:
they match words, not meaning. A model is plugged in with ``embed_with``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.text import bind, tokens

DIM = 4096
TERMS_TYPE = "array<struct<bucket:int,tf:int>>"


def bucket(token: Column, dim: int = DIM) -> Column:
    """First 32 bits of the token's md5, modulo ``dim``."""
    return (F.conv(F.substring(F.md5(token.cast("binary")), 1, 8), 16, 10).cast("bigint") % dim).cast("int")


def term_counts(text: Column, dim: int = DIM) -> Column:
    """Bucket counts of one text as a sorted ``array<struct<bucket, tf>>``, computed within its row.

    Equal buckets are neighbours in the sorted array, so each count is the distance between two
    starts. Exploding the tokens and grouping them again would shuffle every token of the corpus.
    """

    def count(sorted_buckets: Column) -> Column:
        size = F.array_size(sorted_buckets)
        positions = F.sequence(F.lit(0), size - F.lit(1))
        starts = F.filter(
            positions,
            lambda i: (i == 0) | (F.get(sorted_buckets, i) != F.get(sorted_buckets, i - F.lit(1))),
        )

        def lengths(begin: Column) -> Column:
            ends = F.concat(F.slice(begin, F.lit(2), F.array_size(begin)), F.array(size))
            return F.zip_with(
                begin,
                ends,
                lambda a, b: F.struct(F.get(sorted_buckets, a).alias("bucket"), (b - a).cast("int").alias("tf")),
            )

        empty = F.array().cast(TERMS_TYPE)
        return F.when(size == 0, empty).otherwise(bind(starts, lengths))

    hashed = F.sort_array(F.transform(tokens(text), lambda w: bucket(w, dim)))
    return bind(hashed, count)


def bucket_frequencies(df: DataFrame, terms_col: str = "terms") -> DataFrame:
    """Number of rows holding each bucket: at most ``dim`` rows, combined before the shuffle."""
    return (
        df.select(F.explode_outer(F.col(f"{terms_col}.bucket")).alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def idf_table(df: DataFrame, terms_col: str = "terms", dim: int = DIM) -> DataFrame:
    """``bucket, idf`` for all ``dim`` buckets: ln((1 + rows) / (1 + rows holding the bucket))."""
    spark = df.sparkSession
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    every = spark.range(0, dim, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    counts = bucket_frequencies(df, terms_col)
    idf = F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.coalesce(F.col("df"), F.lit(0))))
    return every.join(counts, "bucket", "left").select("bucket", F.coalesce("df", F.lit(0)).alias("df"), idf.alias("idf"))


def idf_array(idf: DataFrame) -> DataFrame:
    """The idf table as one row with one array; its length is the fixed vector dimension."""
    pairs = F.array_sort(F.collect_list(F.struct("bucket", "idf")))
    return idf.agg(F.transform(pairs, lambda p: p["idf"]).alias("idf"))


def weigh(df: DataFrame, idf: DataFrame, terms_col: str = "terms", out: str = "embedding") -> DataFrame:
    """Add ``out`` (``array<struct<bucket, weight>>``, weight = tf * idf) and its length ``norm``.

    The idf array reaches the rows as a scalar subquery of fixed size; nothing is joined or shuffled.
    """
    lookup = idf_array(idf).scalar()
    named = df.withColumn("__idf", lookup)
    weighted = F.transform(
        F.col(terms_col),
        lambda t: F.struct(
            t["bucket"].alias("bucket"), (t["tf"] * F.get(F.col("__idf"), t["bucket"])).alias("weight")
        ),
    )
    square = F.aggregate(F.col(out), F.lit(0.0), lambda acc, t: acc + t["weight"] * t["weight"])
    return named.withColumn(out, weighted).drop("__idf").withColumn("norm", F.sqrt(square))


@dataclass(frozen=True)
class Embedder:
    """A caller's model. ``load`` runs once per task and returns ``texts -> vectors`` of ``dim`` values."""

    name: str
    load: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]]
    dim: int


def embed_with(df: DataFrame, text_col: str, model: Embedder, out: str = "embedding") -> DataFrame:
    """Add vectors of a caller's model.

    Only the text column is sent to Python. Null texts get null vectors; a wrong dimension fails.
    """
    load, dim = model.load, model.dim

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embed = load()
        for texts in batches:
            values = texts.to_pylist()
            known = [t for t in values if t is not None]
            vectors = list(embed(known)) if known else []
            if len(vectors) != len(known) or any(len(v) != dim for v in vectors):
                raise ValueError(f"the model must return one vector of {dim} values per text")
            given = iter(vectors)
            yield pa.array([None if t is None else list(next(given)) for t in values], pa.list_(pa.float32()))

    return df.withColumn(out, run(F.col(text_col)))
