"""Hashes of words and shingles in numpy, and an exchange of packed counts.

A corpus has far more word or shingle occurrences than rows. Here a task turns its rows into blocks of bounded size. A
block keeps, for each range of the hash space (``bucket``), its distinct keys in order, how many occurrences each
has, and the row of each occurrence. Keys and block counts travel to their bucket as byte strings, are summed there over all
blocks, and answers go back to the blocks. A key that every row holds is still one entry a block, so no bucket is hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_KEYS = 700_000  # occurrences a block holds before it is closed
BLOCK_ROWS = 60_000  # fits the two bytes a row number takes
PIECE_BYTES = 1_000_000  # text hashed at once
BUCKET_KEYS = 1_000_000
END = np.uint64(0x9E3779B97F4A7C15)  # the key of the end of a text

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 2**64, 256, np.uint64, endpoint=False)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_VALUE[_BLANK] = 0
_STEP = 0xD6E8FEB86659FD93  # odd, so it has an inverse
_BACK = pow(_STEP, -1, 2**64)


@lru_cache(8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, x, np.uint64) for x in (_STEP, _BACK))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset of each text in them, one more than texts; nulls are empty."""
    texts = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "").cast(pa.large_string())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For one piece of the texts after the other: the first text's number, the hash of every word, and the words of each text."""
    data, offsets = raw_bytes(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, "right")) - 1)
        piece, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        solid = ~_BLANK[piece]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        heads = at[:-1][at[:-1] < len(piece)]
        begins[heads] = solid[heads]
        starts = np.flatnonzero(begins)
        counts = np.diff(np.searchsorted(starts, at))
        if len(starts):
            size = 1 << max(20, int(len(piece)).bit_length())
            up, down = _powers(size)
            hashes = mix(np.add.reduceat(_VALUE[piece] * up[: len(piece)], starts) * down[starts])
        else:
            hashes = np.empty(0, np.uint64)
        yield first, hashes, counts
        first = last


def shingles(hashes: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the runs of ``length`` words and the text of each. A shorter text with words is one run."""
    ends = np.cumsum(counts)
    starts = ends - counts
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - starts[text]
    key, factor = np.zeros(len(hashes), np.uint64), np.uint64(0x2545F4914F6CDD1D)
    live = np.ones(len(hashes), bool)
    for j in range(length):
        there = place + j < counts[text]
        shifted = np.zeros_like(key)
        shifted[: max(0, len(key) - j)] = hashes[j:]
        key = np.where(there, key * factor + shifted, key * factor)
        live &= there
    live |= (place == 0) & (counts[text] < length)
    return mix(key[live]), text[live]


def pack_keys(keys: np.ndarray, width: int) -> bytes:
    """The upper ``width`` bytes of sorted keys, byte plane by byte plane, so that the equal upper bytes compress."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_keys(data: bytes, width: int) -> np.ndarray:
    full = np.zeros((len(data) // width, 8), np.uint8)
    full[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return full.reshape(-1).view(">u8").astype(np.uint64)


def cut(keys: np.ndarray, width: int) -> np.ndarray:
    """Keys with only their upper ``width`` bytes."""
    drop = np.uint64(64 - 8 * width)
    return keys >> drop << drop


def plan(docs: DataFrame, per_key: float = 6.0) -> tuple[int, int]:
    """Bucket bits, and key bytes under which chance collisions are rarer than one key in 4,000, for a table's texts."""
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    keys = max(1.0, chars / per_key)
    return max(4, math.ceil(math.log2(max(1.0, keys / BUCKET_KEYS)))), min(8, max(5, math.ceil((math.log2(keys) + 12) / 8)))


POSTS = pa.schema(
    [("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counted", pa.binary()), ("rows", pa.binary()),
     ("at", pa.binary()), ("times", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary())]
)
POSTS_DDL = "block bigint, bucket int, keys binary, counted binary, rows binary, at binary, times binary, ids binary, sizes binary"
# A piece of texts to: keys, text of each key; sizes of the texts; whether a text is counted in the totals.
KeysOf = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def post(docs: DataFrame, keys_of: KeysOf, bits: int, width: int, counted: str | None = None) -> DataFrame:
    """Blocks of ``doc_id`` and ``text``: a row for each bucket with its distinct keys (``keys``), the occurrences of each
    in counted rows (``counted``), the rows of each (``rows``), those rows (``at``) and the occurrences in each
    (``times``); and a row with bucket -1 with the block's ids and the keys of each row (``sizes``)."""
    docs = docs.select("doc_id", "text", *((counted,) if counted else ()))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        keys, rows, ids, used = [], [], [], []
        held = n = 0

        def close() -> pa.RecordBatch:
            k, r = np.concatenate(keys), np.concatenate(rows)
            order = np.argsort(k, kind="stable")
            k, r = cut(k[order], width), r[order]
            new_key = np.append(True, k[1:] != k[:-1])[: len(k)]
            new = new_key | np.append(True, r[1:] != r[:-1])[: len(k)]
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(k)))
            k, r, new_key = k[first], r[first], new_key[first]
            at_key = np.flatnonzero(new_key)
            weight = times * np.concatenate(used)[r]
            totals = np.add.reduceat(weight, at_key) if len(at_key) else np.empty(0, np.int64)
            per_key = np.diff(np.append(at_key, len(k)))
            distinct = k[at_key]
            bucket = (distinct >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            post_edges = np.append(at_key, len(k))[edges]
            out = {name: [] for name in POSTS.names}
            for b in np.flatnonzero(np.diff(edges)).tolist():
                a, z, pa_, pz = edges[b], edges[b + 1], post_edges[b], post_edges[b + 1]
                row = (
                    number, b, pack_keys(distinct[a:z], width), totals[a:z].astype(np.uint32).tobytes(), per_key[a:z].astype(np.uint16).tobytes(),
                    r[pa_:pz].astype(np.uint16).tobytes(), times[pa_:pz].astype(np.uint32).tobytes(), None, None,
                )
                for name, v in zip(POSTS.names, row):
                    out[name].append(v)
            sizes = np.bincount(r, minlength=n)
            last = (number, -1, None, None, None, None, None, np.concatenate(ids).tobytes(), sizes.astype(np.int64).tobytes())
            for name, v in zip(POSTS.names, last):
                out[name].append(v)
            return pa.RecordBatch.from_pydict(out, POSTS)

        for batch in batches:
            id_ = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            use = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64) if counted else np.ones(len(id_), np.int64)
            for first, hashes, counts in word_hashes(batch.column(1)):
                k, t = keys_of(hashes, counts)
                if n and (held + len(k) > BLOCK_KEYS or n + len(counts) > BLOCK_ROWS):
                    yield close()
                    number += 1
                    keys, rows, ids, used = [], [], [], []
                    held = n = 0
                keys.append(k)
                rows.append(t + n)
                ids.append(id_[first : first + len(counts)])
                used.append(use[first : first + len(counts)])
                held, n = held + len(k), n + len(counts)
        if n:
            yield close()

    return docs.mapInArrow(blocks, POSTS_DDL)


def totals(posts: DataFrame, width: int, answer: Callable[[np.ndarray, np.ndarray], bytes], extra: Callable | None = None) -> DataFrame:
    """``block, bucket, answer``: what ``answer(keys, totals)`` says of each block's keys, totals being sums over all blocks.

    With ``extra(totals of the bucket's distinct keys)`` each bucket also gives a row of block -1.
    """

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        each = [unpack_keys(k, width) for k in group["keys"]]
        counts = np.concatenate([np.frombuffer(c, np.uint32) for c in group["counted"]])
        distinct, where = np.unique(np.concatenate(each), return_inverse=True)
        total = np.bincount(where, counts, len(distinct)).astype(np.int64)
        ends = np.cumsum([len(k) for k in each])
        answers = [answer(k, total[where[e - len(k) : e]]) for k, e in zip(each, ends)]
        blocks = group["block"].tolist()
        if extra:
            blocks, answers = [*blocks, -1], [*answers, extra(total)]
        return pd.DataFrame({"block": blocks, "bucket": key[0], "answer": answers})

    sent = posts.where("bucket >= 0").select("block", "bucket", "keys", "counted")
    return sent.groupBy("bucket").applyInPandas(merge, "block bigint, bucket int, answer binary")
