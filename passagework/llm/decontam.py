"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Words are runs of letters and digits in lower case; shingles are five words (an item of fewer words is one shingle).
A document that holds an item shares a shingle with it, and the places of the shared ones tell which windows, as long as the
item, may be its best (``starts``). Each gets a 64-bit SimHash over its shingles, each weighing as often as it occurs. Fingerprints
are cut into ``RADIUS + 1`` blocks; two within the radius agree on one block at least, so the block index finds all of
them. The radius lies five standard deviations above the distance expected at the threshold. Pairs within it are verified by the exact weighted
similarity of the shingles, sum of minima over sum of maxima.

Everything is built-in expressions. The items' side is broadcast only if its bytes are counted to be within
``BROADCAST_CHARS``. Nulls and odd input: null texts and texts without words match nothing, items with null id or
no words are ignored, equal items match under each id, windows at the ends of a text are cut short. A document is its id and its
text (``KEY``): documents without an id or with a shared one are told apart by their texts, and rows that repeat both
give their matches once. Other columns are ignored or carried along. Empty tables give no match and drop nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.llm.text import join_same, let, whole
from passagework.operators.rows import compute_once
from passagework.session import stage

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BROADCAST_CHARS = 8_000_000
_TOKEN = r"[\p{L}\p{N}]+"
_LONGS = "array<bigint>"
KEY = ["doc_id", "__node"]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__node", F.xxhash64("text"))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(whole(text)), F.lit(_TOKEN), F.lit(0))


def shingles(w: Column, length: int) -> Column:
    """Hashes of the runs of ``length`` words."""
    return F.when(
        F.size(w) >= length,
        F.transform(F.sequence(F.lit(0), F.size(w) - length), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(length)))),
    ).otherwise(F.array().cast(_LONGS))


def simhash(hashes: Column) -> Column:
    """The sign of each bit's sum over the hashes."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda a, h: a + F.call_function("getbit", h, b))
        return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x)
    )


def blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """``radius + 1`` disjoint pieces of the fingerprint, each with its number."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    pieces = [
        F.shiftrightunsigned(fingerprint, lo).bitwiseAND((1 << (hi - lo)) - 1) for lo, hi in zip(edges, edges[1:])
    ]
    return F.array(*(F.struct(F.lit(i).alias("block"), p.alias("value")) for i, p in enumerate(pieces)))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of minima over sum of maxima of the two arrays' counts."""

    def count(x: Column, v: Column) -> Column:
        return F.size(F.filter(x, lambda y: y == v))

    shared = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, v: n + F.least(count(a, v), count(b, v))
    )
    return let(shared, lambda s: s / (F.size(a) + F.size(b) - s))


def starts(aligned: Column, at: Column, n: Column) -> Column:
    """Where windows of ``n`` shingles may be best: as the item lies, from the start of a run of its shingles, or up to the end of one.

    A window that ends on a foreign shingle, or before one more of the item's, is none the worse moved; one cut short by the
    text's end likewise starts with a run.
    """
    ends = F.filter(at, lambda x, k: F.coalesce(F.get(at, k + 1) != x + 1, F.lit(True)))
    begins = F.filter(at, lambda x, k: F.coalesce(F.get(at, k - 1) != x - 1, F.lit(True)))
    return F.array_union(aligned, F.array_union(begins, F.transform(ends, lambda x: x - n + 1)))


def _items(benchmark: DataFrame) -> DataFrame:
    w = compute_once(benchmark.where("item_id is not null"), ["item_id"], w=tokens(F.col("text")))
    w = w.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(SHINGLE)))
    by_length = F.lit(None).cast(_LONGS)
    for n in range(SHINGLE, 0, -1):
        by_length = F.when(F.col("length") == n, shingles(F.col("w"), n)).otherwise(by_length)
    items = compute_once(w, ["item_id", "length"], hs=by_length).distinct()
    return items.select("item_id", "length", "hs", simhash(F.col("hs")).alias("print"))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``doc_id, item_id, similarity, start``: the best window of each item found in a document."""
    found = _matches(keyed(docs.select("doc_id", "text")), benchmark, similarity, radius)
    return found.select("doc_id", "item_id", "similarity", "start")


def _matches(docs: DataFrame, benchmark: DataFrame, similarity: float, radius: int) -> DataFrame:
    """``matches`` of documents told apart by ``KEY``."""
    items = stage(_items(benchmark), "items")
    small = (benchmark.agg(F.sum(F.char_length("text"))).first()[0] or 0) <= BROADCAST_CHARS
    held = F.broadcast if small else lambda df: df
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # five at most
    places = items.select("item_id", "length", F.size("hs").alias("n"), F.posexplode("hs").alias("j", "h"))
    cut = compute_once(docs, KEY, w=tokens(F.col("text")))
    windows = None
    for length in lengths:
        own = cut.select(*KEY, F.posexplode(shingles(F.col("w"), length)).alias("i", "h"))
        hit = own.join(held(places.where(F.col("length") == length)), "h")
        hit = hit.select(*KEY, "item_id", "length", "n", "i", (F.col("i") - F.col("j")).alias("start"))
        windows = hit if windows is None else windows.unionByName(hit)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, __node bigint, item_id {dict(benchmark.dtypes)['item_id']}, similarity double, start int"
    if windows is None:
        return docs.sparkSession.createDataFrame([], schema)
    windows = windows.groupBy(*KEY, "item_id", "length", "n").agg(
        F.collect_set("start").alias("aligned"), F.sort_array(F.collect_set("i")).alias("at")
    )
    windows = windows.select(*KEY, "item_id", "length", "n", starts(F.col("aligned"), F.col("at"), F.col("n")).alias("starts"))
    asked = windows.groupBy(*KEY).agg(F.collect_list(F.struct("item_id", "length", "n", "starts")).alias("asked"))
    asked = stage(asked, "windows")
    met = join_same(docs, asked, KEY, "inner")
    met = compute_once(met, [*KEY, "asked"], w=tokens(F.col("text")))
    made = F.array(*(F.when(F.array_contains(F.col("asked.length"), n), shingles(F.col("w"), n)) for n in range(1, SHINGLE + 1)))
    met = compute_once(met, [*KEY, "asked"], hs=made).select(*KEY, "hs", F.inline("asked"))
    met = met.select(*KEY, "hs", "item_id", "length", "n", F.explode("starts").alias("start"))
    first = F.greatest(F.col("start"), F.lit(0))
    own = F.slice(F.get(F.col("hs"), F.col("length") - 1), first + 1, F.greatest(F.col("start") + F.col("n") - first, F.lit(0)))
    window = compute_once(met, [*KEY, "item_id", "start"], own=own).where(F.size("own") > 0)
    window = window.distinct().withColumn("print", simhash(F.col("own")))
    window = stage(window, "prints")
    sides = [x.select(*k, F.inline(blocks(F.col("print"), radius))) for x, k in (
        (window, [*KEY, "item_id", "start"]), (items, ["item_id"]))]
    found = sides[0].join(held(sides[1]), ["item_id", "block", "value"]).select(*KEY, "item_id", "start").distinct()
    near = join_same(window, found, [*KEY, "item_id", "start"], "left_semi")
    near = near.join(held(items.select("item_id", "hs", F.col("print").alias("wanted"))), "item_id")
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("wanted"))) <= radius)
    scored = near.select(*KEY, "item_id", "start", weighted_similarity(F.col("own"), F.col("hs")).alias("similarity"))
    scored = scored.where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back")))
    out = scored.groupBy(*KEY, "item_id").agg(best.alias("b"))
    return out.select(*KEY, "item_id", "b.similarity", F.greatest(-F.col("b.back"), F.lit(0)).alias("start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without those that hold an item."""
    found = _matches(keyed(docs.select("doc_id", "text")), benchmark, similarity, RADIUS).select(*KEY).distinct()
    return join_same(keyed(docs), found, KEY, "left_anti").drop("__node")
