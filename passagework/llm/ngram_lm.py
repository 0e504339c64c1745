"""Language model scores from a log-frequency Bloom filter.

The filter holds quantised counts of words and word pairs: an n-gram seen ``c`` times is in it once for each level up to
``floor(log c / log BASE)`` and the level is found again by probing until a probe fails, so a count is never
under-read. Counts are taken over all training texts and all of them are in it. If the items are known to fit in ``BITS`` (64 MB) at
eight bits an item, the filter is broadcast. Otherwise it is cut by ranges of the key space, each with eight bits an item at
least; blocks of texts send their distinct words and pairs to the ranges, where counts are summed, and get levels back.

A token's probability is ``trust * c(previous, token) / c(previous) + (1 - trust) * (WORD * c(token) / N + (1 - WORD) / (V +
1))``, where ``trust`` is ``PAIR`` for frequent previous tokens and falls to 0 for rare ones, with counts as read from the filter; the text's end is a token and stands before its first word. The exact
add-one score that it is compared with takes the words' sums from the same exchange, without any filter.

Nulls and odd input: a null or blank text is its end alone; a null id never trains; repeated rows count as often as they
occur and are scored alike; rows that share an id are told apart by their texts; without training text all tokens are unseen. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm import packed
from passagework.session import stage

BITS = 29
BASE = 1.5
PROBES = 3
PER_ITEM = 8
PAIR, TRUSTED, WORD = 0.4, 20.0, 0.8
LEVELS = 128
_SALT = np.random.default_rng(7).integers(1, 2**64, LEVELS + 1, np.uint64, endpoint=False) | np.uint64(1)
_PAIR = np.uint64(0xA0761D6478BD642F)


def tokens(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words of the texts with an end after each text's last, and the text of each token."""
    ends = np.cumsum(counts) + np.arange(len(counts))
    keys = np.full(len(hashes) + len(counts), packed.END)
    keys[np.setdiff1d(np.arange(len(keys)), ends, assume_unique=True)] = hashes
    return keys, np.repeat(np.arange(len(counts)), counts + 1)


def pairs(keys: np.ndarray, text: np.ndarray, width: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The key of each token with the one before it, of ``width`` bytes, and that one's key."""
    before = np.append(packed.END, keys[:-1])[: len(keys)]
    before[np.append(True, text[1:] != text[:-1])[: len(keys)]] = packed.END
    return packed.cut(packed.mix(before * _PAIR + keys), width), before


def level(counts: np.ndarray) -> np.ndarray:
    """0 for unseen; the small lift keeps exact powers on their level."""
    return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9), 0).astype(np.int64)


def value(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level."""
    low, high = BASE ** (levels - 1.0), BASE ** levels.astype(float)
    return np.where(levels > 0, np.sqrt(np.ceil(low - 1e-9) * np.maximum(np.ceil(high - 1e-9) - 1, np.ceil(low - 1e-9))), 0.0)


def positions(keys: np.ndarray, lv: np.ndarray | int, bits: int) -> Iterator[np.ndarray]:
    h = packed.mix(keys * _SALT[lv] + np.asarray(lv, np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (h + np.uint64(i) * step) & np.uint64((1 << bits) - 1)


def read(filled: np.ndarray, bits: int, keys: np.ndarray, start: int) -> np.ndarray:
    """The level of each key, by probing from ``start`` up until one fails; 0 if none is there."""
    found, live, lv = np.zeros(len(keys), np.int64), np.arange(len(keys)), start
    while len(live) and lv <= LEVELS:
        hit = np.ones(len(live), bool)
        for p in positions(keys[live], lv, bits):
            hit &= (filled[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        live = live[hit]
        found[live], lv = lv, lv + 1
    return found


@dataclass(frozen=True)
class Model:
    """Word keys and pair keys share the filter. Levels start at ``word_from`` and ``pair_from``.

    Pairs have keys of ``width`` bytes. A model too large for one filter has the n-grams in ``grams``, by ``1 << range_bits``
    ranges, and no bits of its own.
    """

    bits: np.ndarray
    word_from: int
    pair_from: int
    tokens: int
    distinct: int
    grams: DataFrame | None = None
    range_bits: int = 0
    width: int = 8

    def read(self, keys: np.ndarray, start: int) -> np.ndarray:
        return read(self.bits, (8 * len(self.bits)).bit_length() - 1, keys, start)

    def score(self, keys: np.ndarray, text: np.ndarray) -> np.ndarray:
        """log10 of each token's probability."""
        word, both = np.unique(np.append(keys, packed.END)), np.unique(pairs(keys, text, self.width)[0])
        return weigh(keys, text, self.read(word, self.word_from), self.read(both, self.pair_from), self.tokens, self.distinct, self.width)


def weigh(
    keys: np.ndarray, text: np.ndarray, words: np.ndarray, joint: np.ndarray, total: int, distinct: int, width: int = 8
) -> np.ndarray:
    """log10 of each token's probability by the levels of the different words, with the end, and of the different pairs, in order."""
    pair, before = pairs(keys, text, width)
    word, of_word = np.unique(np.append(keys, packed.END), return_inverse=True)
    seen = value(words)
    joint = value(joint)[np.unique(pair, return_inverse=True)[1]]
    own = seen[of_word[:-1]]
    context = seen[np.searchsorted(word, before)]
    p = WORD * own / max(1, total) + (1 - WORD) / (distinct + 1)
    trust = PAIR * context / (context + TRUSTED)
    p = (1 - trust) * p + trust * np.minimum(1.0, joint / np.maximum(context, np.maximum(joint, 1)))
    return np.log10(np.minimum(p, 1.0))


def small(numbers: np.ndarray, width: int) -> bytes:
    """Whole numbers of ``width`` bytes, byte plane by byte plane, so that the mostly empty upper ones compress."""
    return packed.pack_keys(numbers.astype(np.uint64) << np.uint64(64 - 8 * width), width)


def numbers(data: bytes, width: int) -> np.ndarray:
    return (packed.unpack_keys(data, width) >> np.uint64(64 - 8 * width)).astype(np.int64)


HEADS = "block bigint, ids binary, sizes binary, trains binary, words binary, at binary, n bigint, learned bigint"
ASKED = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
ASKED_DDL = "block bigint, bucket int, kind int, keys binary, counts binary"
TOLD_DDL = "block bigint, bucket int, kind int, keys binary, counts binary, levels binary, histogram array<bigint>"
SUMS, GRAMS = -1, -2  # rows of ``told`` that belong to a range and not to a block of texts


def text_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of ``doc_id bigint, text, trains boolean``: a block's ids, tokens of each text, which texts train, different
    words from frequent to rare, and the places of all tokens in that order; and its numbers of tokens and training tokens."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        size = n = 0

        def close() -> pa.RecordBatch:
            ids, use, sizes, keys = map(np.concatenate, zip(*held))
            words, at, often = np.unique(keys, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            row = (
                number, ids.tobytes(), small(sizes, 4), use.tobytes(), packed.pack_keys(words[order], 8), small(rank[at], 4),
                len(keys), int(sizes[use > 0].sum()),
            )
            return pa.RecordBatch.from_pydict(dict(zip((x.split()[0] for x in HEADS.split(", ")), ([x] for x in row))))

        for batch in batches:
            id_ = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            use = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            for first, hashes, counts in packed.word_hashes(batch.column(1)):
                keys = tokens(hashes, counts)[0]
                if held and (size + len(keys) > packed.BLOCK_KEYS or n + len(counts) > packed.BLOCK_ROWS):
                    yield close()
                    number += 1
                    held.clear()
                    size = n = 0
                here = slice(first, first + len(counts))
                held.append((id_[here], use[here], counts + 1, keys))
                size, n = size + len(keys), n + len(counts)
        if held:
            yield close()

    return rows.select("doc_id", "text", "trains").mapInArrow(blocks, HEADS)


def tokens_of(sizes: bytes, words: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A block's tokens and the text of each."""
    n = numbers(sizes, 4)
    return packed.unpack_keys(words, 8)[numbers(at, 4)], np.repeat(np.arange(len(n)), n)


def ask(heads: DataFrame, bits: int, width: int) -> DataFrame:
    """A row for each block, range of the key space and kind: different words (kind 0) or pairs (1), with their training counts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, text = tokens_of(row["sizes"], row["words"], row["at"])
                weight = np.frombuffer(row["trains"], np.uint8)[text]
                out = []
                for kind, k in enumerate((keys, pairs(keys, text, width)[0])):
                    k, at = np.unique(k, return_inverse=True)
                    counts = np.bincount(at, weight, len(k))
                    edges = np.searchsorted((k >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
                    for b in np.flatnonzero(np.diff(edges)).tolist():
                        part = slice(edges[b], edges[b + 1])
                        out.append((row["block"], b, kind, packed.pack_keys(k[part], 8 if kind == 0 else width), small(counts[part], 4)))
                yield pa.RecordBatch.from_pydict(dict(zip(ASKED.names, map(list, zip(*out)))), ASKED)

    return heads.select("block", "sizes", "trains", "words", "at").mapInArrow(send, ASKED_DDL)


def probe(keys: np.ndarray, levels: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The levels of ``asked`` as the filter of one range reads them, which holds ``keys`` on their ``levels``."""
    size = max(16, math.ceil(math.log2(max(1, PER_ITEM * int(levels.sum())))))
    bit = np.zeros(1 << size, bool)
    for lv in range(1, int(levels.max(initial=0)) + 1):
        for p in positions(keys[levels >= lv], lv, size):
            bit[p] = True
    return read(np.packbits(bit, bitorder="little"), size, asked, 1)


def tell(asked: DataFrame, width: int, by_range: bool, keep: bool) -> DataFrame:
    """Sums each range's training counts over all blocks and tells the blocks: of words the exact counts, and if ``by_range`` of
    words and pairs the levels by the range's filter. With ``keep`` also the n-grams of the range with their levels (block
    ``GRAMS``); always the numbers of different and of all training words (block ``SUMS``)."""

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bucket, kind = key
        wide = 8 if kind == 0 else width
        each = [packed.unpack_keys(k, wide) for k in group["keys"]]
        distinct, where = np.unique(np.concatenate(each), return_inverse=True)
        total = np.bincount(where, np.concatenate([numbers(c, 4) for c in group["counts"]]), len(distinct)).astype(np.int64)
        lv = level(total)
        there = lv > 0
        found = probe(distinct[there], lv[there], distinct).astype(np.uint8) if by_range else None
        out: list[tuple] = []
        if kind == 0 or by_range:
            ends = np.cumsum([len(k) for k in each])
            for block, k, end in zip(group["block"].tolist(), each, ends):
                at = where[end - len(k) : end]
                out.append((block, bucket, kind, None, small(total[at], 8) if kind == 0 else None, found[at].tobytes() if by_range else None, None))
        if kind == 0:
            out.append((SUMS, bucket, kind, None, small(np.array([there.sum(), total.sum()]), 8), None, None))
        if keep:
            histogram = np.bincount(lv[there], minlength=LEVELS + 1).tolist()
            out.append((GRAMS, bucket, kind, packed.pack_keys(distinct[there], wide), None, lv[there].astype(np.uint8).tobytes(), histogram))
        return pd.DataFrame(out, columns=["block", "bucket", "kind", "keys", "counts", "levels", "histogram"])

    return asked.groupBy("bucket", "kind").applyInPandas(merge, TOLD_DDL)


def ranges(heads: DataFrame) -> tuple[int, int, int]:
    """How many bits of a key name its range, the bytes of a pair's key, and the number of training tokens."""
    n, learned = heads.agg(F.sum("n"), F.sum("learned")).first()
    keys = max(1, 2 * (n or 0))
    bits = max(4, math.ceil(math.log2(max(1.0, keys / packed.BUCKET_KEYS))))
    return bits, min(8, max(5, math.ceil((math.log2(keys) + 12) / 8))), learned or 0


def lowest_levels(words: np.ndarray, pairs_: np.ndarray, room: int) -> tuple[int, int]:
    """The lowest starting levels of words and pairs, by histogram of levels, at which all items fit in ``room``."""
    start = [1, 1]
    items = lambda h, s: int((h[s:] * np.arange(1, len(h) - s + 1)).sum())
    while items(words, start[0]) + items(pairs_, start[1]) > room:
        kind = 1 if items(pairs_, start[1]) >= items(words, start[0]) else 0
        start[kind] += 1
    return start[0], start[1]


def train(docs: DataFrame, distinct: int, total: int) -> Model:
    """The model of all rows of ``docs``; ``distinct`` and ``total`` are their exact numbers of tokens."""
    rows = docs.select(F.lit(0).cast("bigint").alias("doc_id"), "text", F.lit(True).alias("trains"))
    heads = stage(text_blocks(rows), "blocks", "zstd")
    bits, width, _ = ranges(heads)
    grams = stage(tell(ask(heads, bits, width), width, False, True), "ngrams", "zstd").where(F.col("block") == GRAMS)
    histogram = grams.select("kind", F.posexplode("histogram").alias("level", "n")).groupBy("kind", "level").agg(F.sum("n").alias("n"))
    sizes = np.zeros((2, LEVELS + 1), np.int64)
    for kind, lv, n in histogram.collect():  # LEVELS numbers a kind
        sizes[kind, lv] = n
    if lowest_levels(sizes[0], sizes[1], (1 << BITS) // PER_ITEM) != (1, 1):
        return Model(np.empty(0, np.uint8), 1, 1, total, distinct, grams, bits, width)
    return Model(fill(grams, width), 1, 1, total, distinct, width=width)


def fill(grams: DataFrame, width: int) -> np.ndarray:
    """The ``1 << BITS`` bits of the filter that holds all n-grams of ``grams``, put together from segments."""
    size_bits, segment = BITS, 16

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The filter bits of each row's items, segment by segment."""
        for batch in batches:
            for kind, keys, levels in zip(*(batch.column(i).to_pylist() for i in range(3))):
                k, top = packed.unpack_keys(keys, 8 if kind == 0 else width), np.frombuffer(levels, np.uint8).astype(np.int64)
                found = [np.empty(0, np.uint64)]
                for lv in range(1, int(top.max(initial=0)) + 1):
                    found += positions(k[top >= lv], lv, size_bits)
                at = np.unique(np.concatenate(found))
                part = (at >> np.uint64(segment)).astype(np.int64)
                ids, first = np.unique(part, return_index=True)
                split = np.split((at & np.uint64((1 << segment) - 1)).astype(np.uint16), first[1:]) if len(ids) else []
                yield pa.RecordBatch.from_pydict({"segment": pa.array(ids, pa.int64()), "at": pa.array([x.tobytes() for x in split], pa.binary())})

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bit = np.zeros(1 << segment, bool)
        bit[np.frombuffer(b"".join(group["at"]), np.uint16)] = True
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(bit, bitorder="little").tobytes()]})

    rows = grams.select("kind", "keys", "levels").mapInArrow(insert, "segment bigint, at binary")
    filled, size = np.zeros(1 << (size_bits - 3), np.uint8), 1 << (segment - 3)
    for s, data in rows.groupBy("segment").applyInPandas(merge, "segment bigint, bits binary").toLocalIterator():
        filled[s * size : (s + 1) * size] = np.frombuffer(data, np.uint8)
    return filled


def finish(heads: DataFrame, told: DataFrame, total: int, distinct: int, width: int, model: Broadcast | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, logs, score`` of each text by what its block is told; levels come from ``model`` if it is given.

    ``logs`` sums log10 of each token's exact count and one; where no exact counts are told, it and ``n_known`` are 0.
    """

    def scored(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        head, right = left.iloc[0], right.sort_values(["kind", "bucket"])
        ids = np.frombuffer(head["ids"], np.int64)
        keys, text = tokens_of(head["sizes"], head["words"], head["at"])
        n = np.bincount(text, minlength=len(ids))
        exact = [numbers(x, 8) for x in right["counts"] if x is not None]
        logs, known = np.zeros(len(ids)), np.zeros(len(ids))
        if exact:
            c = np.concatenate(exact)[np.unique(keys, return_inverse=True)[1]]
            logs, known = np.bincount(text, np.log10(c + 1.0), len(ids)), np.bincount(text, c > 0, len(ids))
        if model is None:
            words, joint = (np.frombuffer(b"".join(right.loc[right["kind"] == kind, "levels"]), np.uint8).astype(np.int64) for kind in (0, 1))
            each = weigh(keys, text, words, joint, total, distinct, width)
        else:
            each = model.value.score(keys, text)
        score_ = np.bincount(text, each, len(ids))
        return pd.DataFrame({"doc_id": ids, "n_tokens": n, "n_known": known.astype(np.int64), "logs": logs, "score": score_})

    left = heads.select("block", "ids", "sizes", "words", "at").groupBy("block")
    right = told.select("block", "bucket", "kind", "counts", "levels").groupBy("block")
    return left.cogroup(right).applyInPandas(scored, "doc_id bigint, n_tokens bigint, n_known bigint, logs double, score double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: the log10 probability of each text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if model.grams is not None:
        return score_by_range(rows, model)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for first, hashes, counts in packed.word_hashes(batch.column(1)):
                keys, text = tokens(hashes, counts)
                total[first : first + len(counts)] = np.bincount(text, held.value.score(keys, text), len(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total)], ["doc_id", "score"])

    return rows.mapInArrow(scored, "doc_id bigint, score double")


def score_by_range(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` by a filter for each range of the key space, to which blocks of texts send their distinct n-grams."""
    width = model.width

    def answer(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        wide = 8 if key[1] == 0 else width
        k = np.concatenate([np.empty(0, np.uint64), *(packed.unpack_keys(x, wide) for x in right["keys"])])
        top = np.frombuffer(b"".join(right["levels"]), np.uint8).astype(np.int64)
        each = [packed.unpack_keys(x, wide) for x in left["keys"]]
        found = probe(k, top, np.concatenate([np.empty(0, np.uint64), *each])).astype(np.uint8)
        cuts = np.cumsum([0, *map(len, each)])
        levels = [found[a:z].tobytes() for a, z in zip(cuts, cuts[1:])]
        return pd.DataFrame({"block": left["block"], "bucket": key[0], "kind": key[1], "counts": None, "levels": levels})

    heads = stage(text_blocks(rows.withColumn("trains", F.lit(False))), "blocks", "zstd")
    asked = ask(heads, model.range_bits, width).select("block", "bucket", "kind", "keys").groupBy("bucket", "kind")
    told = asked.cogroup(model.grams.select("bucket", "kind", "keys", "levels").groupBy("bucket", "kind"))
    told = told.applyInPandas(answer, "block bigint, bucket int, kind int, counts binary, levels binary")
    return finish(heads, told, model.tokens, model.distinct, width).select("doc_id", "score")


def score_held_out(docs: DataFrame, modulo: int = 7, rest: int = 2) -> DataFrame:
    """Every text's scores, learning from those whose id's crc32 leaves another remainder than ``rest``.

    The texts' blocks are written once; their words and pairs travel to the ranges once, for the counts and the answers alike.
    """
    trains = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulo != rest, F.lit(False))
    # rows of one id and text have equal scores; rows that share only the id do not
    named = docs.select("doc_id", "text", F.xxhash64("doc_id", F.col("text").isNull(), "text").alias("node"))
    heads = stage(text_blocks(named.select(F.col("node").alias("doc_id"), "text", trains.alias("trains"))), "blocks", "zstd")
    bits, width, total = ranges(heads)
    # a word and a pair for each token, and an n-gram has no more levels than occurrences
    fits = 2 * total <= (1 << BITS) // PER_ITEM
    told = stage(tell(ask(heads, bits, width), width, not fits, fits), "answers", "zstd")
    sums = told.where(F.col("block") == SUMS).select("counts").mapInPandas(_numbers, "v bigint")
    distinct = sums.agg(F.sum("v")).first()[0] or 0
    model = None
    if fits:
        filled = fill(told.where(F.col("block") == GRAMS), width)
        model = docs.sparkSession.sparkContext.broadcast(Model(filled, 1, 1, total, distinct, width=width))
    each = finish(heads, told.where("block >= 0"), total, distinct, width, model)
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))
    each = each.select(F.col("doc_id").alias("node"), F.struct(base.alias("base_score"), "n_tokens", "n_known", "score").alias("of"))
    rows = named.select("node", "doc_id").join(each.groupBy("node").agg(F.first("of").alias("of")), "node")
    return rows.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulo == rest, F.lit(True)).alias("held_out"),
        "of.n_tokens", "of.n_known", F.lit(total).cast("bigint").alias("train_tokens"), "of.base_score", "of.score",
    )


def _numbers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"v": [int(numbers(c, 8)[0]) for c in frame["counts"]]})
