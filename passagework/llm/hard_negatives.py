"""Hard negatives by Strassen products of anchor and candidate tiles.

Anchors (a stated set of rows) are scored against all rows by integer inner products. Candidates are dealt to tiles of bounded
size, and every tile gets all anchors, which stream past it in blocks: a task holds its tile and one block. The
block's scores are one matrix product by Strassen's recursion: seven products of quarters instead of eight, each operand padded
with zeros to even sides, down to ``LEAF``. Additions are on int64, which is exact as long as the scores themselves fit (sums
that wrap on the way wrap back), so scores are too.

Two rounds over the same tiles. The first keeps the best ``positives`` rows of the anchor's label, the second, knowing the
positives' scores, the best ``negatives`` rows of other labels within each positive's window. Both keep heaps of fixed size for an
anchor (and positive): a task merges those of its parts, and the tasks' heaps are merged by a shuffle of their rows, of which
Spark keeps no more than a heap a task before. A label that a third of all rows hold is spread over all tiles like any other.

Nulls and odd input: rows without id, label or vector, or with a null, NaN or infinite entry take no part; of vectors of different
lengths those of the commonest length count. Rows that share an id are rows of their own: each is an anchor if its id
is one, and another row for the rest; equal scores go to the smaller id. Anchors without another row of their label, or
without a row in any window, have no rows. Other columns are ignored. Entries of ``LARGEST`` or more in size fail the job, as scores might
leave a long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.llm.vectors import common_length, finite, whole_steps
from passagework.operators.ranking import top_k
from passagework.session import stage

FACTOR = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, OF = 30, 90, 100  # the window: LOW/OF to HIGH/OF of the positive's score
LEAF = 16
TILE_VALUES = 8_000_000  # numbers of a task's candidates, 8 bytes each
LEAST_ROWS = 2_048  # of a tile, so that few rows do not make many tiles
BLOCK_ANCHORS = 512
BLOCK_SCORES = 2_000_000
LARGEST = 1 << 20  # so that scores and windows of 2**16 entries fit a long


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` on int64, by seven products of quarters while no side is at ``LEAF`` yet."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b)[:m, :n]
    i, j, l = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((m, n), np.int64)
    out[:i, :l], out[:i, l:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :l], out[i:, l:] = p2 + p4, p1 - p2 + p3 + p6
    return out


@dataclass
class Heaps:
    """The best ``k`` entries of each of ``n`` owners: higher scores first, then smaller ids, then smaller rows."""

    n: int
    k: int

    def __post_init__(self) -> None:
        empty = np.empty(0, np.int64)
        self.owner = self.score = self.id = self.row = empty
        self.floor = np.full(self.n, np.iinfo(np.int64).min)

    def offer(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """A matrix of scores, an owner a line, columns by id; only entries that could still enter are sorted."""
        allowed &= scores >= self.floor[:, None]
        if scores.shape[1] > self.k:
            held = np.where(allowed, scores, np.iinfo(np.int64).min)
            bar = np.partition(held, -self.k, axis=1)[:, -self.k]
            allowed &= scores >= bar[:, None]
            if allowed.sum() > 4 * self.k * len(scores):
                # of many equal scores at the bar the first ids are enough
                equal = allowed & (scores == bar[:, None])
                allowed &= ~equal | (np.cumsum(equal, axis=1) <= self.k)
        owner, column = np.nonzero(allowed)
        self.merge(owner, scores[owner, column], ids[column], rows[column])

    def merge(self, owner: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        owner, score = np.append(self.owner, owner), np.append(self.score, score)
        id_, row = np.append(self.id, id_), np.append(self.row, row)
        order = np.lexsort((row, id_, -score, owner))
        owner = owner[order]
        first = np.searchsorted(owner, owner)
        keep = np.arange(len(owner)) - first < self.k
        order = order[keep]
        self.owner, self.score, self.id, self.row = owner[keep], score[order], id_[order], row[order]
        last = np.arange(len(owner))[keep] - first[keep] == self.k - 1
        self.floor[self.owner[last]] = self.score[last]


def prepared(vectors: DataFrame, row_id: Column, label: Column, vector: str) -> DataFrame:
    """``row, id, label, x`` of the rows that take part, written once; ``row`` tells rows apart that share an id."""
    usable = vectors.select(row_id.cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).alias("v"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    x = whole_steps(F.col("v"), FACTOR)
    large = F.exists(x, lambda c: F.abs(c) >= LARGEST)
    x = F.when(large, F.raise_error(F.lit("a vector's entry is too large"))).otherwise(x)
    usable = usable.select("id", "label", x.cast("array<int>").alias("x"))
    return stage(usable.withColumn("row", F.monotonically_increasing_id()), "vectors")


def tiles(rows: DataFrame, length: int) -> int:
    """How many tiles: enough for bounded tiles, and for all cores if the rows suffice."""
    n = rows.count()
    most = max(1, TILE_VALUES // max(length, 1))
    wanted = min(2 * rows.sparkSession.sparkContext.defaultParallelism, n // LEAST_ROWS)
    return max(1, wanted, math.ceil(n / most))


def past_tiles(rows: DataFrame, anchors: DataFrame, count: int, use: Callable, schema: str) -> DataFrame:
    """``use(block, tile)`` for each block of anchors and each tile of rows, as batches of ``schema``.

    ``anchors`` has the columns of ``rows`` and ``known array<bigint>``. A tile's rows stand before the anchors in its partition.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("tile")
    none = F.lit(None).cast("array<bigint>").alias("known")
    own = rows.select((F.pmod(F.xxhash64("row"), F.lit(count))).cast("int").alias("tile"), F.lit(0).alias("kind"), "row", "id", "label", "x", none)
    asked = anchors.select(every, F.lit(1).alias("kind"), "row", "id", "label", "x", "known")
    dealt = own.unionByName(asked).repartitionById(count, F.col("tile")).sortWithinPartitions("tile", "kind")

    def arrays(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(batches)
        out = {c: table.column(c).to_numpy().astype(np.int64) for c in ("row", "id", "label")}
        flat = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        out |= {"x": flat.reshape(table.num_rows, -1).astype(np.int64), "known": table.column("known")}
        return out

    def by_id(tile: dict) -> dict:
        order = np.lexsort((tile["row"], tile["id"]))
        return {c: tile[c][order] for c in ("row", "id", "label", "x")}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        tile, at = None, None
        for batch in batches:
            places, kinds = batch.column("tile").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(places) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(start, end - start)
                if not part.num_rows:
                    continue
                if places[start] != at:
                    held, tile, at = [], None, places[start]
                if kinds[start] == 0:
                    held.append(part)
                    continue
                if tile is None:
                    tile = by_id(arrays(held)) if held else {}
                if tile:
                    for b in range(0, part.num_rows, BLOCK_ANCHORS):
                        yield from use(arrays([part.slice(b, BLOCK_ANCHORS)]), tile)

    return dealt.mapInArrow(task, schema)


def _parts(tile: dict[str, np.ndarray], anchors: int) -> Iterator[slice]:
    """Runs of the tile's rows whose scores with a block stay within ``BLOCK_SCORES``."""
    step = max(LEAF, BLOCK_SCORES // anchors)
    for start in range(0, len(tile["row"]), step):
        yield slice(start, start + step)


def positives(rows: DataFrame, anchors: DataFrame, count: int, k: int = POSITIVES) -> DataFrame:
    """``row, known``: each anchor's row and its best other rows of the same label as structs ``rk, id, score``."""

    def best(block: dict, tile: dict) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(block["row"]), k)
        for part in _parts(tile, heaps.n):
            scores = strassen(block["x"], np.ascontiguousarray(tile["x"][part].T))
            allowed = block["label"][:, None] == tile["label"][part][None, :]
            allowed &= block["row"][:, None] != tile["row"][part][None, :]
            heaps.offer(scores, allowed, tile["id"][part], tile["row"][part])
        columns = [block["row"][heaps.owner], heaps.id, heaps.score, heaps.row]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "id", "score", "other"])

    found = past_tiles(rows, anchors.withColumn("known", F.lit(None).cast("array<bigint>")), count, best, "row bigint, id bigint, score bigint, other bigint")
    ranked = top_k(found, ["row"], [F.col("score").desc(), F.col("id"), F.col("other")], k)
    return ranked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rk", "id", "score"))).alias("known"))


def negatives(rows: DataFrame, anchors: DataFrame, count: int, k: int = NEGATIVES, window: tuple[int, int, int] = (LOW, HIGH, OF)) -> DataFrame:
    """``row, place, rank, negative_id, negative_score`` of the best ``k`` rows of other labels in each window.

    ``known`` of ``anchors`` are the positives' scores; ``place`` counts them from 0.
    """
    low, high, of = window

    def best(block: dict, tile: dict) -> Iterator[pa.RecordBatch]:
        known = block["known"].to_pylist()
        places = max(map(len, known))
        heaps = [Heaps(len(known), k) for _ in range(places)]
        for part in _parts(tile, len(known)):
            scores = strassen(block["x"], np.ascontiguousarray(tile["x"][part].T))
            other = block["label"][:, None] != tile["label"][part][None, :]
            for j, heap in enumerate(heaps):
                there = np.array([j < len(s) for s in known])
                score = np.array([s[j] if j < len(s) else 0 for s in known], np.int64)
                # bounds in whole scores: low * p <= of * s <= high * p
                least, most = -((-low * score) // of), (high * score) // of
                allowed = other & there[:, None] & (scores >= least[:, None]) & (scores <= most[:, None])
                heap.offer(scores, allowed, tile["id"][part], tile["row"][part])
        for j, heap in enumerate(heaps):
            columns = [block["row"][heap.owner], np.full(len(heap.owner), j, np.int64), heap.id, heap.score, heap.row]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "place", "negative_id", "negative_score", "other"])

    schema = "row bigint, place bigint, negative_id bigint, negative_score bigint, other bigint"
    found = past_tiles(rows, anchors, count, best, schema)
    order = [F.col("negative_score").desc(), F.col("negative_id"), F.col("other")]
    return top_k(found, ["row", "place"], order, k, rank="rank").drop("other")


def mine(vectors: DataFrame, anchor: Column, row_id: Column, label: Column, vector: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``row_id`` and ``label`` are expressions over ``vectors``; ``anchor`` one over its result's ``id``.
    """
    rows = prepared(vectors, row_id, label, vector)
    length = common_length(rows, "x")
    rows = rows.where(F.size("x") == length)
    count = tiles(rows, length)
    anchors = rows.where(anchor)
    known = stage(positives(rows, anchors, count), "positives")
    asked = anchors.drop("known").join(known.select("row", F.col("known.score").alias("known")), "row")
    found = negatives(rows, asked, count)
    each = anchors.select("row", F.col("id").alias("anchor_id")).join(known, "row")
    each = each.select("row", "anchor_id", F.posexplode("known").alias("place", "p"))
    each = each.select("row", "place", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return found.join(each, ["row", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
