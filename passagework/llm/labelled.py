"""Held-out rows and the bounded training sample of the two text classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulo: int) -> Column:
    return F.crc32(doc_id.cast("string")) % modulo


def held_out(doc_id: Column, modulo: int, rest: int) -> Column:
    """Whether labels of this id may not be learned; a null id is held out."""
    return F.coalesce(remainder(doc_id, modulo) == rest, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulo: int, rest: int, rows: int, chars: int | None = None) -> DataFrame:
    """``text, y`` of at most ``rows`` labelled documents outside the held-out part, chosen by a hash of the id, and
    with ``chars`` of the first of these whose texts have no more characters together.

    Null labels and documents without a label are not used; contradicting labels of one id count as 1. The chosen
    ids are at most ``rows``, so they are broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"), modulo, rest))
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    if chars is not None:
        sized = docs.select("doc_id", F.char_length("text").alias("size")).join(F.broadcast(chosen), "doc_id")
        sized = sized.groupBy("doc_id", "y").agg(F.sum("size").alias("size"))  # one row an id, so ``rows`` at most
        so_far = F.coalesce(F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id")), F.lit(0))
        chosen = sized.withColumn("so_far", so_far).where(F.col("so_far") <= chars).select("doc_id", "y")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")
