"""Exact top-k from an inverted index with block maxima, in shards of chunks.

A chunk's id hashes it to a shard (``part``) of about ``BLOCK`` chunks. Postings, an index's weights by bucket, stand in blocks: a block
holds the chunks of one shard and bucket whose weights, at vector length 1, lie in one half-octave (``level``), and knows its largest
weight. ``levels`` sums this up in a row for each bucket and level, a table bounded by the dimension.

A question's score is the sum of its terms' products, so a bucket's and level's largest weight bounds what a chunk can get there.
First the blocks of largest impact give some chunks, whose exact scores give a bar: the k-th best of them. Then

* terms whose bounds together stay below the bar cannot make a hit alone: their postings are not summed at first;
* nor is a level of another term, if its bound plus those of all other terms stays below the bar;
* chunks that were met but whose score plus the bounds of all they were not met in stays below the bar are dropped.

A shard's blocks and a bounded number of questions meet in one task, which sums a question's products in an array of the shard's chunks; so
what is shuffled is the postings, once for that many questions, and not a row for each product. The k best sums of a shard raise its bar.
If chunks are left that an unread level may count for, it is summed too, and the shard returns the k best. Nothing is
approximate: the rows are those of the full scan with a score above 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passagework.operators.nearest import DIGITS
from passagework.operators.ranking import top_k
from passagework.operators.retrieval import Index, embed_questions
from passagework.session import stage

# Chunks of a shard, so entries of a block at most, on average.
BLOCK = 16_384
# Questions that meet a shard's blocks in one task.
QUESTIONS = 4_096
LEVELS_PER_OCTAVE = 2
# Levels lie between -END and END, as numbers go, so a bucket's number times LEVELS leaves them room.
LEVELS, END = 16_384, 8_000
# Chunks that give the bar, in multiples of k.
SEEDS = 8
# Scores are rounded before they are ranked; sums of products differ by less.
SLACK = 2e-6


@dataclass(frozen=True)
class Postings:
    """``blocks``: ``bucket, level, part, largest, entries``; ``levels``: ``bucket, level, n, largest, parts``, the number of shards."""

    blocks: DataFrame
    levels: DataFrame


def write_postings(index: Index, path: str, block: int = BLOCK) -> Postings:
    """Write the postings of an index's built-in vectors."""
    if index.idf is None:
        raise ValueError("only the built-in weights, which are never negative, have postings")
    entry = F.explode("embedding").alias("e")
    each = index.chunks.where(F.col("norm") > 0).select(F.col(index.chunk_id).alias("id"), "norm", entry)
    each = each.select("id", F.col("e.bucket").alias("bucket"), (F.col("e.weight") / F.col("norm")).alias("w")).where("w > 0")
    each = each.withColumn("level", F.floor(F.log2("w") * LEVELS_PER_OCTAVE).cast("int"))
    parts = max(1, math.ceil(index.chunks.count() / block))
    split = each.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    entries = F.collect_list(F.struct("id", "w")).alias("entries")
    blocks = split.groupBy("bucket", "level", "part").agg(F.max("w").alias("largest"), entries)
    blocks.sortWithinPartitions("bucket", "level").write.parquet(f"{path}/blocks")
    written = each.sparkSession.read.parquet(f"{path}/blocks")
    sizes = F.sum(F.array_size("entries")).alias("n"), F.max("largest").alias("largest"), F.lit(parts).alias("parts")
    written.groupBy("bucket", "level").agg(*sizes).coalesce(1).write.parquet(f"{path}/levels")
    return open_postings(each.sparkSession, path)


def open_postings(spark: SparkSession, path: str) -> Postings:
    return Postings(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/levels"))


def _exact(pairs: DataFrame, asked: DataFrame, index: Index) -> DataFrame:
    """``qid, id, score`` of pairs ``qid, id``, from the stored vectors."""
    chunks = index.chunks.select(F.col(index.chunk_id).alias("id"), F.col("embedding").alias("v"), F.col("norm").alias("length"))
    chunks = chunks.join(pairs.select("id").distinct(), "id", "left_semi")  # before their weights are made
    met = pairs.join(chunks, "id").join(asked.select("qid", "weights"), "qid")
    product = F.aggregate("v", F.lit(0.0), lambda a, e: a + e["weight"] * F.coalesce(F.element_at("weights", e["bucket"]), F.lit(0.0)))
    return met.select("qid", "id", F.round(product / F.col("length"), DIGITS).alias("score"))


def _bars(terms: DataFrame, asked: DataFrame, index: Index, postings: Postings, k: int) -> DataFrame:
    """``qid, bar``: the k-th best score among the chunks of the blocks of largest impact; 0 where they are fewer."""
    enough = SEEDS * k
    by_impact = Window.partitionBy("qid").orderBy(F.col("impact").desc(), "bucket", "level")
    before = F.sum(F.least("n", F.lit(enough))).over(by_impact.rowsBetween(Window.unboundedPreceding, -1))
    ranked = terms.withColumn("impact", F.col("q") * F.col("largest")).withColumn("before", F.coalesce(before, F.lit(0)))
    seeds = ranked.where(F.col("before") < enough).select("qid", "bucket", "level", "n", "parts")
    # of a large level, shards that have about as many as are wanted
    some = (F.col("first.part") * F.col("n") <= F.col("parts") * enough) & F.expr("s.bucket = first.bucket and s.level = first.level")
    first = postings.blocks.select("bucket", "level", "part", F.slice("entries.id", 1, enough).alias("ids"))
    pairs = seeds.alias("s").join(first.alias("first"), some).select("qid", F.explode("ids").alias("id")).distinct()
    best = top_k(_exact(pairs, asked, index), ["qid"], [F.col("score").desc(), F.col("id")], k)
    return best.groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(0.0).alias("bar"))


def needed_levels(terms: DataFrame, bars: DataFrame) -> DataFrame:
    """``terms`` (``qid, bucket, q, level, n, largest, parts``) with ``bar``, whether a level is ``read``, and ``skipped``, the most that a
    chunk can get from the question's bucket where it was not met in what is read of it; ``rest`` sums that up over the buckets."""
    own = terms.groupBy("qid", "bucket", "q").agg((F.col("q") * F.max("largest")).alias("most"))
    upward = Window.partitionBy("qid").orderBy("most", "bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("qid")
    own = own.join(bars, "qid", "left").withColumn("bar", F.coalesce("bar", F.lit(0.0)) - SLACK)
    own = own.withColumn("essential", F.sum("most").over(upward) >= F.col("bar")).withColumn("others", F.sum("most").over(whole) - F.col("most"))
    each = terms.join(own.select("qid", "bucket", "most", "bar", "essential", "others"), ["qid", "bucket"])
    bound = F.col("q") * F.col("largest")
    each = each.withColumn("read", F.col("essential") & (bound + F.col("others") >= F.col("bar")))
    bucket = Window.partitionBy("qid", "bucket")
    unread = F.coalesce(F.max(F.when(~F.col("read"), bound)).over(bucket), F.lit(0.0))
    each = each.withColumn("skipped", F.when(F.col("essential"), unread).otherwise(F.col("most")))
    # each bucket counts once, by its first level
    each = each.withColumn("once", F.when(F.row_number().over(bucket.orderBy("level")) == 1, F.col("skipped")).otherwise(0.0))
    return each.withColumn("rest", F.sum("once").over(whole)).drop("once")


def question_terms(asked: DataFrame, postings: Postings) -> DataFrame:
    """``qid, bucket, q, level, n, largest, parts``: the levels of every term of the questions."""
    terms = asked.select("qid", F.explode("weights").alias("bucket", "q"))
    return terms.join(F.broadcast(postings.levels), "bucket")


def prepared(questions: DataFrame, index: Index, question_id: str, text: str) -> DataFrame:
    """``qid, weights``: each question's weights at length 1, by bucket, without zeros."""
    asked = embed_questions(questions.select(F.col(question_id).alias("qid"), text), text, index).where(F.col("norm") > 0)
    positive = F.filter("embedding", lambda e: e["weight"] > 0)
    return asked.select(
        "qid", F.map_from_entries(F.transform(positive, lambda e: F.struct(e["bucket"], e["weight"] / F.col("norm")))).alias("weights")
    )


class _Shard:
    """A shard's blocks as one array of postings by bucket and level, so that a bucket's levels from one on are a slice of it."""

    def __init__(self, blocks: pa.Table):
        blocks = blocks.combine_chunks()
        key = blocks["bucket"].to_numpy().astype(np.int64) * LEVELS + blocks["level"].to_numpy()
        order = np.argsort(key)
        self.key = key[order]
        entries = blocks["entries"].take(pa.array(order)).combine_chunks()
        self.ends = np.concatenate([[0], np.cumsum(pc.list_value_length(entries).to_numpy(zero_copy_only=False))])
        flat = entries.flatten()
        coded = flat.field("id").dictionary_encode()
        by_id = pc.sort_indices(coded.dictionary)
        self.ids = coded.dictionary.take(by_id)
        places = np.empty(len(by_id), np.int64)
        places[by_id.to_numpy()] = np.arange(len(by_id))
        self.chunk = places[coded.indices.to_numpy()]  # chunks are numbered in the order of their ids
        self.w = flat.field("w").to_numpy()

    def _postings(self, bucket: int, low: int, high: int) -> slice:
        a, z = np.searchsorted(self.key, [bucket * LEVELS + low, bucket * LEVELS + high])
        return slice(self.ends[a], self.ends[z])

    def search(self, terms: list[dict], bar: float, rest: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best chunks and their scores, or fewer: those that can be hits."""
        score, known = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for t in terms:
            met = self._postings(t["bucket"], t["level"], END)
            score[self.chunk[met]] += t["q"] * self.w[met]
            known[self.chunk[met]] += t["skipped"]
        if len(score) > k:
            bar = max(bar, np.partition(score, len(score) - k)[len(score) - k] - SLACK)
        at = np.flatnonzero((score > 0) & (score + rest - known >= bar))
        if len(at) and rest > 0:
            for t in terms:
                unread = self._postings(t["bucket"], -END, t["level"])
                score[self.chunk[unread]] += t["q"] * self.w[unread]
        found = np.round(score[at], DIGITS)
        first = np.lexsort((at, -found))[:k]
        return at[first], found[first]


def _meet(levels: DataFrame, postings: Postings, questions: int, k: int) -> DataFrame:
    """``qid, id, score``: of every shard, the ``k`` best chunks of each question at most."""
    parts = postings.levels.agg(F.max("parts")).first()[0] or 0
    groups = max(1, math.ceil(questions / QUESTIONS))
    # a question's terms, which are read from the lowest level on that can matter, as bounds grow with the level
    from_level = F.coalesce(F.min(F.when(F.col("read"), F.col("level"))), F.lit(END)).alias("level")
    term = levels.groupBy("qid", "bucket").agg(*(F.first(c).alias(c) for c in ("q", "skipped", "bar", "rest")), from_level)
    terms = F.collect_list(F.struct("bucket", "q", "level", "skipped")).alias("terms")
    asked = term.groupBy("qid").agg(F.first("bar").alias("bar"), F.first("rest").alias("rest"), terms)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)) if parts else F.array().cast("array<int>"))
    asked = asked.select(every.alias("part"), F.pmod(F.xxhash64("qid"), F.lit(groups)).cast("int").alias("group"), "qid", "bar", "rest", "terms")
    blocks = postings.blocks.join(F.broadcast(levels.select("bucket").distinct()), "bucket", "left_semi")
    blocks = blocks.select("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "bucket", "level", "entries")
    id_type = dict(postings.blocks.select(F.explode("entries.id").alias("id")).dtypes)["id"]
    schema = f"qid {dict(levels.dtypes)['qid']}, id {id_type}, score double"

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            empty = pa.table({"qid": pa.array([], right["qid"].type), "id": pa.array([], left["entries"].type.value_type.field("id").type)})
            return empty.append_column("score", pa.array([], pa.float64()))
        shard = _Shard(left)
        found = [shard.search(t, bar, rest, k) for t, bar, rest in zip(*(right[c].to_pylist() for c in ("terms", "bar", "rest")))]
        question = pa.array(np.repeat(np.arange(len(found)), [len(at) for at, _ in found]))
        at, score = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        return pa.table({"qid": right["qid"].take(question), "id": shard.ids.take(pa.array(at)), "score": pa.array(score)})

    return blocks.groupBy("part", "group").cogroup(asked.groupBy("part", "group")).applyInArrow(search, schema)


def retrieve_by_postings(
    questions: DataFrame, index: Index, postings: Postings, k: int = 4, question_id: str = "qid", text: str = "question"
) -> DataFrame:
    """The ``k`` best chunks with a score above 0 of every question, as by ``retrieve``: ``question_id, chunk_id, rk, score``."""
    asked = stage(prepared(questions, index, question_id, text), "asked")
    terms = question_terms(asked, postings)
    levels = stage(needed_levels(terms, _bars(terms, asked, index, postings, k)), "levels")
    ranked = top_k(_meet(levels, postings, asked.count(), k), ["qid"], [F.col("score").desc(), F.col("id")], k)
    return ranked.select(F.col("qid").alias(question_id), F.col("id").alias(index.chunk_id), "rk", "score")
