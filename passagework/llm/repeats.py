"""Suffix-array dedup: removal of every byte covered by a string of ``LENGTH`` bytes that starts anywhere else too.

Every window of 200 bytes holds a core: the 150 bytes with the smallest hash among its 51 possible ones. Equal windows
have equal cores at equal places, so two windows are compared only if they share a core. A twice-seen Bloom filter
(``line_dedup``) of bounded size passes the cores that may occur again; they are the documents of a collection, each a
string of at most 50 bytes, the core as one symbol, and 50 bytes.

Shards of that collection are ordered column by column, from the last symbol to the first. A round inserts one symbol in front of
every string's suffix: the symbols in the order of the suffixes are the collection's Burrows-Wheeler transform, and its stable
counting sort is the next order. Common prefixes of neighbours follow along: one symbol more than the least common prefix between the two
in the order before. After the core and ``a`` symbols of the left side, strings with a common prefix of 200 bytes
with a neighbour have their window at ``a`` repeated. A shard is bounded and its columns are held in memory, not in external files. Construction
over whole documents would take as many rounds, each over all suffixes, as the longest text has bytes; over cores it takes 101.

Texts are scanned four times: for the filter, for the cores that occur more than ``HOT`` times, for the strings, and for the places of the
repeated ones. A scan takes some texts in a row as one piece of bytes, small enough for a core's cache, in which no core or window crosses the end of
a text. Equal strings of some texts in a row enter once. A very common core is not put in one shard: each window of
its strings is a row of its own, dealt out by its digest and counted there, which is exact and spreads.

Nulls and odd input: a null text has no bytes; repeated rows are documents of their own, so they repeat each other; ids may repeat
or be null, and rows that repeat id and text gather the marks of one; texts under 200 bytes stay whole. ``kept`` is bytes, as a cut may fall inside a character.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm import packed
from passagework.llm.line_dedup import _probes, twice_seen
from passagework.llm.text import join_same, whole
from passagework.session import stage

LENGTH = 200
CORE = 150
SIDE = LENGTH - CORE
MAX_BITS = 30
SHARD_BYTES = 2_000_000  # of text a shard stands for
HOT = 60_000
MOST_HOT = 1_000_000  # cores treated so, the commonest first; every task has their hashes
GIVEN_ROWS = 20_000  # strings cut at once
HELD_ROWS = 60_000  # strings a scan compares before it gives them back
PIECE_BYTES = 32_768  # texts scanned at once; a longer one is a piece of its own
CUT_BYTES = 1_000_000  # texts cut at once, likewise
_END = 256  # the symbol beyond a text: equal to nothing


def _slide(x: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """``of`` over every run of ``width`` values, by doubling."""
    out, done = x, 1
    while 2 * done <= width:
        out, done = of(out[:-done], out[done:]), 2 * done
    return of(out[: len(x) - width + 1], out[width - done :]) if done < width else out


def pieces(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """First and last text (excluded) of runs of texts with at most ``size`` bytes, or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def cores(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the cores of a piece of texts that end at ``ends``: of each window the ``CORE`` bytes with the smallest hash, all ties.

    The upper halves of the products are compared; only the cores' hashes are mixed. The hash chooses and deals out; what is equal is decided by digests.
    """
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = packed._powers(1 << max(16, int(len(data) + 1).bit_length()))
    values = data.astype(np.uint64)
    values *= up[: len(data)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    h = sums[CORE:] - sums[:-CORE]
    h *= down[: len(h)]
    upper = (h >> np.uint64(32)).astype(np.uint32)
    least = np.zeros(len(upper) + SIDE, np.uint32)  # of the window that starts SIDE places before; no window, 0
    for end in ends.tolist():
        upper[max(0, end - CORE + 1) : end] = 0xFFFFFFFF
    least[SIDE : len(upper)] = _slide(upper, SIDE + 1, np.minimum)
    for end in ends.tolist():
        least[max(0, end - LENGTH + 1) + SIDE : end + SIDE] = 0
    at = np.flatnonzero(upper == _slide(least, SIDE + 1, np.maximum))
    return at, packed.mix(h[at])


def order_columns(columns: Iterator[tuple[np.ndarray, np.ndarray | int]], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The order of ``n`` strings' suffixes and the common prefix of each with the one before it, after each column.

    A column is the strings' symbols and the bytes a symbol stands for; ``_END`` equals nothing.
    """
    order, common = np.arange(n), np.zeros(n, np.int32)
    for symbols, size in columns:
        bwt = symbols[order]
        step = np.argsort(bwt, kind="stable")
        # range minima of the common prefixes between the old places of new neighbours
        table = [common]
        while 2 << (len(table) - 1) <= n:
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        p, q = step[:-1], step[1:]
        same = (bwt[p] == bwt[q]) & (bwt[p] != _END)
        at = np.flatnonzero(same)
        lo, hi = p[at] + 1, q[at] + 1
        rank = np.floor(np.log2(hi - lo)).astype(np.int64)
        least = np.empty(len(at), np.int32)
        for r in np.unique(rank).tolist():
            m = rank == r
            least[m] = np.minimum(table[r][lo[m]], table[r][hi[m] - (1 << r)])
        common = np.zeros(n, np.int32)
        common[at + 1] = least + size
        order = order[step]
        yield order, common


def repeated_windows(core_id: np.ndarray, sides: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each string, a bit for each number of left bytes at which its window is also another string's."""
    n = len(core_id)
    place = np.arange(SIDE)
    after, before = sides[:, SIDE:].astype(np.uint16), sides[:, :SIDE][:, ::-1].astype(np.uint16)
    after[place >= right[:, None]] = _END
    before[place >= left[:, None]] = _END
    after, before = np.ascontiguousarray(after.T), np.ascontiguousarray(before.T)

    def columns() -> Iterator[tuple[np.ndarray, int]]:
        for j in range(SIDE - 1, -1, -1):
            yield after[j], 1
        yield core_id.astype(np.int64) + _END + 1, CORE
        for j in range(SIDE):
            yield before[j], 1

    mask = np.zeros(n, np.int64)
    for done, (order, common) in enumerate(order_columns(columns(), n)):
        if done >= SIDE:
            hit = common >= LENGTH
            hit[:-1] |= hit[1:]
            mask[order[hit]] |= 1 << (done - SIDE)
    return mask


def strings_at(raw: bytes, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the strings around the cores at some places of a piece, and their numbers of bytes on either side.

    ``start`` and ``end`` are those of each core's text. A name is 128 bits of a digest of the string, by its left bytes, so equal strings
    have equal names.
    """
    there = np.stack([np.minimum(at - start, SIDE), np.minimum(end - CORE - at, SIDE)], axis=1)
    froms, tos = (at - there[:, 0]).tolist(), (at + CORE + there[:, 1]).tolist()
    return _digests([xxhash.xxh3_128_digest(raw[a:z], left) for a, z, left in zip(froms, tos, there[:, 0].tolist())]), there


def _digests(each: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(each), np.uint64).reshape(-1, 2)


def sides_at(data: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The bytes on either side of the cores, zeros beyond the text."""
    padded = np.concatenate([np.zeros(SIDE, np.uint8), data, np.zeros(SIDE, np.uint8)])
    runs = np.lib.stride_tricks.sliding_window_view(padded, SIDE)
    sides = np.concatenate([runs[at], runs[at + LENGTH]], axis=1)
    edge = np.flatnonzero((there < SIDE).any(axis=1))
    place = np.arange(SIDE)
    sides[edge] *= np.concatenate([place[::-1] < there[edge, :1], place < there[edge, 1:]], axis=1)
    return sides


def _grouped(names: np.ndarray, *first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts equal names together, ``first`` ones by themselves, and where each name's run starts in it."""
    keys = [*first, names[:, 0], names[:, 1]]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(new)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as byte strings."""
    flat = np.ascontiguousarray(rows)
    width = flat.itemsize * (flat.shape[1] if flat.ndim > 1 else 1)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _hashes(docs: DataFrame) -> DataFrame:
    """``hashes`` of the cores, a row for each piece of texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = packed.raw_bytes(batch.column(0))
            found = [cores(data[offsets[a] : offsets[z]], offsets[a + 1 : z + 1] - offsets[a])[1] for a, z in pieces(offsets, PIECE_BYTES)]
            sizes = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32)
            values = pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(sizes), values)], ["hashes"])

    return docs.select("text").mapInArrow(each, "hashes array<bigint>")


class _Suspects:
    """The scans over texts after the filter's: each finds the cores that the filter passes."""

    def __init__(self, docs: DataFrame) -> None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.docs, self.bits = docs, min(MAX_BITS, max(16, int(size / 6).bit_length()))
        self.held = docs.sparkSession.sparkContext.broadcast(twice_seen(_hashes(docs), self.bits))

    def _pieces(self):
        """From a column of texts to the bytes of each piece with suspects, the number of its first text and where its texts start and end; each suspect's
        text, counted from that one, its place and its hash."""
        held, bits = self.held, self.bits

        def each(column: pa.Array) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
            data, offsets = packed.raw_bytes(column)
            for first, last in pieces(offsets, PIECE_BYTES):
                piece, edges = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                at, h = cores(piece, edges[1:])
                hit = np.ones(len(at), bool)
                for p in _probes(h, bits):
                    hit &= (held.value[p >> np.uint64(3)] >> (7 - (p & np.uint64(7))).astype(np.uint8) & 1).astype(bool)
                if hit.any():
                    at = at[hit]
                    yield piece, first, edges, np.searchsorted(edges, at, "right") - 1, at, h[hit]

        return each

    def crowded(self) -> DataFrame:
        """``h`` of the cores that occur more than ``HOT`` times; a batch counts its own first."""
        texts = self._pieces()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h, n = np.unique(np.concatenate([np.empty(0, np.uint64), *(x[5] for x in texts(batch.column(0)))]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        counted = self.docs.select("text").mapInArrow(count, "h bigint, n bigint")
        counted = counted.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > HOT)
        return counted.orderBy(F.col("n").desc(), "h").limit(MOST_HOT).select("h")

    def strings(self, hot: np.ndarray) -> DataFrame:
        """A row for each different string of some texts in a row, and how often they have it (``a`` is -1); of a string with a ``hot``
        core a row for each window instead, ``a`` its left bytes and ``core`` its digest. Rows of one ``key`` must meet."""
        texts, held = self._pieces(), self.docs.sparkSession.sparkContext.broadcast(hot)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts: list[tuple[np.ndarray, ...]] = []
                for data, _, edges, of, at, h in texts(batch.column(0)):
                    raw = data.tobytes()
                    for start in range(0, len(at), GIVEN_ROWS):
                        own = slice(start, start + GIVEN_ROWS)
                        name, there = strings_at(raw, at[own], edges[of[own]], edges[of[own] + 1])
                        core = _digests([xxhash.xxh3_128_digest(raw[a : a + CORE]) for a in at[own].tolist()])
                        parts.append((h[own].view(np.int64), name, core, sides_at(data, at[own], there), there))
                        if sum(len(p[0]) for p in parts) > HELD_ROWS:
                            yield from rows(parts)
                            parts = []
                if parts:
                    yield from rows(parts)

        def rows(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            h, name, core, sides, there = map(np.concatenate, zip(*parts))
            order, starts = _grouped(name)
            n = np.diff(np.append(starts, len(order)))
            at = order[starts]
            common = np.isin(h[at], held.value)
            usual = at[~common]
            size = len(usual)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[usual]), pa.array(np.full(size, -1, np.int32)), _binary(name[usual]), _binary(core[usual]), _binary(sides[usual]),
                    pa.array(there[usual, 0].astype(np.int32)), pa.array(there[usual, 1].astype(np.int32)), pa.array(n[~common]),
                ], _STRINGS.names,
            )
            windows: list[tuple] = []
            for i, times in zip(at[common].tolist(), n[common].tolist()):
                left, right = there[i].tolist()
                before, middle, after = sides[i, :SIDE].tobytes(), core[i].tobytes(), sides[i, SIDE:].tobytes()
                for a in range(max(0, SIDE - right), left + 1):
                    w = xxhash.xxh3_128_digest(before[SIDE - a :] + middle + after[: SIDE - a])
                    windows.append((int.from_bytes(w[:8], "little", signed=True), a, name[i].tobytes(), w, b"", 0, 0, times))
                if len(windows) > HELD_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*windows), _STRINGS.types)], _STRINGS.names)
                    windows = []
            if windows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*windows), _STRINGS.types)], _STRINGS.names)

        return self.docs.select("text").mapInArrow(cut, "key bigint, a int, string binary, core binary, sides binary, before int, after int, n bigint")

    def places(self) -> DataFrame:
        """``doc_id, node, string, at``: a row for each string of a text, with all its places."""
        texts = self._pieces()

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of: list[np.ndarray] = []
                names: list[np.ndarray] = []
                places: list[np.ndarray] = []
                sizes: list[np.ndarray] = []
                held = 0
                for data, first, edges, text, at, _ in texts(batch.column(2)):
                    raw, start, end = data.tobytes(), edges[text], edges[text + 1]
                    cut = [slice(s, s + GIVEN_ROWS) for s in range(0, len(at), GIVEN_ROWS)]
                    name = np.concatenate([strings_at(raw, at[x], start[x], end[x])[0] for x in cut])
                    order, starts = _grouped(name, text)
                    of.append(first + text[order[starts]])
                    names.append(name[order[starts]])
                    places.append((at - start)[order])
                    sizes.append(np.diff(np.append(starts, len(order))))
                    held += len(starts)
                    if held > HELD_ROWS:
                        yield rows(batch, of, names, places, sizes)
                        of, names, places, sizes, held = [], [], [], [], 0
                if of:
                    yield rows(batch, of, names, places, sizes)

        def rows(batch: pa.RecordBatch, of: list, names: list, places: list, sizes: list) -> pa.RecordBatch:
            taken = [batch.column(c).take(pa.array(np.concatenate(of))) for c in (0, 1)]
            ends = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
            at = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(places).astype(np.int32)))
            return pa.RecordBatch.from_arrays([*taken, _binary(np.concatenate(names)), at], ["doc_id", "node", "string", "at"])

        id_type = dict(self.docs.dtypes)["doc_id"]
        return self.docs.select("doc_id", "node", "text").mapInArrow(find, f"doc_id {id_type}, node bigint, string binary, at array<int>")


_STRINGS = pa.schema(
    [("key", pa.int64()), ("a", pa.int32()), ("string", pa.binary()), ("core", pa.binary()), ("sides", pa.binary()), ("before", pa.int32()),
     ("after", pa.int32()), ("n", pa.int64())]
)


def _room(left: int, right: int) -> int:
    """The mask of all windows that a string has bytes for."""
    lo, hi = max(SIDE - right, 0), min(left, SIDE)
    return (2 << hi) - (1 << lo) if lo <= hi else 0


def masks(suspects: _Suspects) -> DataFrame:
    """``string, mask`` of the strings with a repeated window."""
    hot = np.array(sorted(r["h"] for r in suspects.crowded().collect()), np.int64)
    size = suspects.docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, int(size / SHARD_BYTES))

    def shard(group: pd.DataFrame) -> pd.DataFrame:
        """Equal strings are joined; those that occur twice have all their windows repeated. Windows of hot cores are counted."""
        windows, group = group[group["a"] >= 0], group[group["a"] < 0]
        group = group.groupby("string", sort=False, as_index=False).agg({"core": "first", "sides": "first", "before": "first", "after": "first", "n": "sum"})
        left, right = group["before"].to_numpy(), group["after"].to_numpy()
        own = np.array([_room(a, z) if n > 1 else 0 for a, z, n in zip(left.tolist(), right.tolist(), group["n"].tolist())], np.int64)
        core_id = pd.factorize(group["core"])[0]
        at = np.flatnonzero(np.bincount(core_id)[core_id] > 1) if len(core_id) else np.empty(0, np.int64)
        if len(at):
            sides = np.frombuffer(b"".join(group["sides"].iloc[at]), np.uint8).reshape(-1, 2 * SIDE)
            own[at] |= repeated_windows(core_id[at], sides, left[at], right[at])
        again = windows[windows.groupby(["a", "core"])["n"].transform("sum") > 1]
        found = own != 0
        return pd.DataFrame(
            {"string": [*group["string"][found], *again["string"]], "mask": np.append(own[found], np.left_shift(1, again["a"].to_numpy(np.int64)))}
        )

    dealt = suspects.strings(hot).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    found = dealt.drop("key").groupBy("shard").applyInPandas(shard, "string binary, mask bigint")
    return found.groupBy("string").agg(F.bit_or("mask").alias("mask"))


_CUT = T.StructType([T.StructField("removed", T.LongType()), T.StructField("spans", T.LongType()), T.StructField("kept", T.BinaryType())])


@F.arrow_udf(_CUT)
def _cut(text: pa.Array, at: pa.Array, mask: pa.Array) -> pa.Array:
    """Each text without the windows whose cores are at ``at``, a window for each bit of ``mask``; null without marks."""
    data, offsets = packed.raw_bytes(text)
    strings = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(at), 0).to_numpy(zero_copy_only=False)))
    at = at.flatten()
    edges = np.append(0, np.cumsum(pc.list_value_length(at).to_numpy(zero_copy_only=False)))
    per_string = np.diff(edges)
    at, mask = at.flatten().to_numpy(zero_copy_only=False), mask.flatten().to_numpy(zero_copy_only=False)
    removed, spans, sizes, kept = [], [], [np.zeros(1, np.int64)], []
    for first, last in pieces(offsets, CUT_BYTES):
        piece, starts = data[offsets[first] : offsets[last]], offsets[first:last] - offsets[first]
        shift = np.repeat(starts, np.diff(edges[strings[first : last + 1]]))
        a, z = strings[first], strings[last]
        places, marks = at[edges[a] : edges[z]] + shift, np.repeat(mask[a:z], per_string[a:z])
        begun = np.zeros(len(piece) + 1, np.int32)
        for s in range(0, len(places), GIVEN_ROWS):
            own = slice(s, s + GIVEN_ROWS)
            bits = np.unpackbits(marks[own].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            which, left = np.nonzero(bits)
            begun[places[own][which] - left + 1] = 1
        np.cumsum(begun, out=begun)
        ago = np.zeros_like(begun)
        ago[LENGTH:] = begun[:-LENGTH]
        gone = begun[1:] > ago[1:]
        heads = gone.copy()
        heads[1:] &= ~gone[:-1]
        inside = starts[starts < len(piece)]
        heads[inside] = gone[inside]
        so_far, heads_so_far = (np.append(np.int32(0), np.cumsum(x, dtype=np.int32)) for x in (gone, heads))
        ends = offsets[first + 1 : last + 1] - offsets[first]
        removed.append(so_far[ends] - so_far[starts])
        spans.append(heads_so_far[ends] - heads_so_far[starts])
        sizes.append(ends - starts - removed[-1])
        kept.append(piece[~gone].tobytes())
    there = ~pc.is_null(text).to_numpy(zero_copy_only=False) & (np.diff(strings) > 0)
    bounds = np.cumsum(np.concatenate(sizes)).astype(np.int32)
    buffers = [np.packbits(there, bitorder="little").tobytes(), bounds.tobytes(), b"".join(kept)]
    stays = pa.Array.from_buffers(pa.binary(), len(text), [pa.py_buffer(b) for b in buffers])
    numbers = [pa.array(np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64)) for x in (removed, spans)]
    return pa.StructArray.from_arrays([*numbers, stays], ["removed", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` is the bytes that stay."""
    docs = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn("node", F.xxhash64("text"))
    suspects = _Suspects(docs)
    marked = suspects.places().join(stage(masks(suspects), "masks"), "string")
    marked = marked.groupBy("doc_id", "node").agg(F.collect_set(F.struct("at", "mask")).alias("marks"))
    met = join_same(docs, marked, ["doc_id", "node"], "left")
    text = F.when(F.col("marks").isNotNull(), F.col("text"))
    met = met.withColumn("cut", _cut(text, F.col("marks.at"), F.col("marks.mask")))
    return met.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.coalesce("cut.removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("cut.spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("cut.kept", F.col("text").cast("binary")).alias("kept"),
    )
