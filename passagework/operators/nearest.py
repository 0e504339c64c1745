"""Exact k-nearest-neighbour join of two vector tables, dense or sparse.

Three ways lead to the same rows:

* *scan*: a question side of proven size goes to every task and the corpus is read where it lies. Each
  task keeps the best k per question while it streams its partition, so it returns at most
  ``questions * k`` rows and the corpus is never shuffled.
* *stream*: any other question side. The questions are written once to the shared folder. A task reads its part of the corpus
  once, where it lies, holds a bounded number of rows and streams the question blocks past them. Neither side is counted, and the
  corpus is never shuffled or copied.
* *grid*: the questions are too many and Python tasks cannot open the shared folder. Both sides are cut into blocks of bounded size by a
  hash of their id, each pair of blocks meets in one task by an ordinary shuffle, and each cell returns its best k.

All end in a top-k per question. The hits of a scan are few, at most ``questions * k``, and carry a
broadcast hint where that is proven small. Scores are rounded before ranking and ties go to the smallest id, in
the tasks as in the final ranking, so any number of exact copies costs no more than k rows per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.operators.ranking import top_k
from passagework.session import scratch_path
from passagework.sources.shared import SharedParquet, readable

METRICS = ("cosine", "l2", "relevance")
DIGITS = 6
# Bound of the scan way: values of the question vectors in memory (8 bytes each), and questions.
SCAN_VALUES = 8_000_000
SCAN_ROWS = 20_000
# Scores held at once in a task, and rows per block of the grid way.
CELL_SCORES = 2_000_000
# Share of the lengths' squares below which a squared distance has lost digits.
CLOSE = 0.01
# Cores above which the tasks' rows are ranked in two steps.
WIDE_CLUSTER = 512
# Hits of the scan way that later joins may broadcast; their number is known to be questions * k.
BROADCAST_HITS = 100_000
GRID_QUESTIONS = 8_192
GRID_CORPUS = 65_536
# The stream way: questions of a block, and values of the corpus rows a task holds while the blocks pass (8 bytes each).
STREAM_QUESTIONS = 4_096
STREAM_VALUES = 8_000_000


def _id_type(field: T.DataType) -> pa.DataType:
    if isinstance(field, T.StringType):
        return pa.string()
    if isinstance(field, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return pa.int64()
    raise TypeError(f"vector ids must be strings or integers, not {field.simpleString()}")


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as a sortable array; strings as bytes, whose order is the order Spark sorts strings in."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return np.array(column.cast(pa.binary()).to_pylist(), dtype=bytes)
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


class _Dense:
    """Rows of equally long arrays."""

    def __init__(self, column: pa.ListArray):
        lengths = np.diff(column.offsets.to_numpy())
        if len(lengths) and (lengths != lengths[0]).any():
            raise ValueError("vectors of one table must have the same dimension")
        dim = int(lengths[0]) if len(lengths) else 0
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.width = max(dim, 1)
        self.rows = flat.reshape(len(lengths), dim)
        self.squares = np.einsum("ij,ij->i", self.rows, self.rows)

    def take(self, index: np.ndarray) -> _Dense:
        out = object.__new__(_Dense)
        out.width, out.rows, out.squares = self.width, self.rows[index], self.squares[index]
        return out

    def dots(self, other: _Dense) -> np.ndarray:
        if self.rows.shape[1] != other.rows.shape[1]:
            raise ValueError(f"dimensions differ: {self.rows.shape[1]} and {other.rows.shape[1]}")
        return self.rows @ other.rows.T

    def exact_square(self, other: _Dense, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        gap = self.rows[i] - other.rows[j]
        return np.einsum("ij,ij->i", gap, gap)


class _Sparse:
    """Rows of ``(bucket, weight)`` pairs below a fixed dimension."""

    def __init__(self, column: pa.ListArray, dim: int):
        self.width = dim
        pairs = column.flatten()
        self.bounds = column.offsets.to_numpy() - column.offsets[0].as_py()
        self.bucket = pairs.field("bucket").to_numpy(zero_copy_only=False).astype(np.int64)
        self.weight = pairs.field("weight").to_numpy(zero_copy_only=False).astype(np.float64)
        self.squares = self._row_sums(self.weight * self.weight)

    def _row_sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of each row's values along the first axis; empty rows sum to zero."""
        out = np.zeros((len(self.bounds) - 1, *values.shape[1:]))
        filled = np.flatnonzero(np.diff(self.bounds))
        if len(filled):
            out[filled] = np.add.reduceat(values, self.bounds[filled], axis=0)
        return out

    def take(self, index: np.ndarray) -> _Sparse:
        out = object.__new__(_Sparse)
        out.width, out.squares = self.width, self.squares[index]
        sizes = np.diff(self.bounds)[index]
        out.bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.bounds[index] - out.bounds[:-1], sizes) + np.arange(out.bounds[-1])
        out.bucket, out.weight = self.bucket[at], self.weight[at]
        return out

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self.squares), self.width))
        out[self.row_of_pair(), self.bucket] = self.weight
        return out

    def row_of_pair(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.squares)), np.diff(self.bounds))

    def dots(self, other: _Sparse) -> np.ndarray:
        """Products of all rows, by matching equal buckets; a bounded number of matches at a time."""
        height, width = len(self.squares), len(other.squares)
        order = np.argsort(self.bucket, kind="stable")
        rows, weights = self.row_of_pair()[order], self.weight[order]
        first = np.searchsorted(self.bucket[order], np.arange(self.width + 1))
        matches = np.diff(first)[other.bucket]
        columns, reached = other.row_of_pair(), np.cumsum(matches)
        out = np.zeros(height * width)
        begin = 0
        while begin < len(matches):
            done = reached[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(reached, done + CELL_SCORES, side="right")))
            n = matches[begin:end]
            pair = np.repeat(np.arange(begin, end), n)
            at = first[other.bucket[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            cells = rows[at] * width + columns[pair]
            out += np.bincount(cells, weights[at] * other.weight[pair], minlength=height * width)
            begin = end
        return out.reshape(height, width)

    def exact_square(self, other: _Sparse, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """By the pairs' own buckets: rows are never filled up to the dimension."""
        left, right = self.take(i), other.take(j)
        place = np.concatenate([left.row_of_pair(), right.row_of_pair()]) * self.width + np.concatenate([left.bucket, right.bucket])
        cells, at = np.unique(place, return_inverse=True)
        gap = np.bincount(at, np.concatenate([left.weight, -right.weight]), minlength=len(cells))
        return np.bincount(cells // self.width, gap * gap, minlength=len(i))


class _Best:
    """The best k rows per question seen so far, by rounded score and then id."""

    def __init__(self, questions, k: int, metric: str):
        self.questions, self.k, self.metric = questions, k, metric
        size = len(questions.squares)
        self.floor = np.full(size, -np.inf)
        # a vector with a null, NaN or infinite element has no score with anything
        self.live = np.flatnonzero(np.isfinite(questions.squares))
        self.kept: list[tuple | None] = [None] * size

    def _scores(self, block, corpus, dots: np.ndarray) -> np.ndarray:
        """Scores that grow with nearness, up to the slack below."""
        if self.metric == "cosine":
            return dots / np.sqrt(block.squares[:, None] * corpus.squares[None, :])
        return self._from_square(np.maximum(block.squares[:, None] + corpus.squares[None, :] - 2 * dots, 0))

    def _from_square(self, square: np.ndarray) -> np.ndarray:
        return -np.sqrt(square) if self.metric == "l2" else 1.0 - square / math.sqrt(2.0)

    def add(self, ids: np.ndarray, corpus) -> None:
        usable = np.isfinite(corpus.squares)
        if self.metric == "cosine":
            usable &= corpus.squares > 0
        if not usable.all():
            keep = np.flatnonzero(usable)
            ids, corpus = ids[keep], corpus.take(keep)
        if not len(ids):
            return
        order = np.argsort(ids, kind="stable")  # then the first of equal scores is the one of the smallest id
        ids, corpus = ids[order], corpus.take(order)
        step = max(1, CELL_SCORES // len(ids))
        for begin in range(0, len(self.live), step):
            index = self.live[begin : begin + step]
            self._add_block(index, self.questions.take(index), ids, corpus)

    def _add_block(self, index: np.ndarray, block, ids: np.ndarray, corpus) -> None:
        dots = block.dots(corpus)
        scores = self._scores(block, corpus, dots)
        k = min(self.k, len(ids))
        bar = np.full(len(index), -np.inf)
        if len(ids) > self.k:
            # Questions that have k rows already are held to those; only the others need a bar from here.
            fresh = np.flatnonzero(np.isneginf(self.floor[index]))
            bar[fresh] = np.partition(scores[fresh], len(ids) - k, axis=1)[:, len(ids) - k]
        # Rounding, and cancellation in squared distances, may reorder what lies this close.
        slack = 2e-6
        if self.metric != "cosine":
            largest = max(block.squares.max(), corpus.squares.max())
            slack += 1e-6 * (math.sqrt(largest) if self.metric == "l2" else largest)
        bar = np.maximum(bar, self.floor[index]) - slack
        rows, cols = np.nonzero(scores >= bar[:, None])
        values = scores[rows, cols]
        if self.metric != "cosine":
            values = self._from_square(self._squares(block, corpus, rows, cols, dots))
        values = np.round(values, DIGITS) + 0.0
        # Candidates come in question order, so each question's are a slice.
        touched = np.unique(rows)
        ends = np.searchsorted(rows, touched, side="right")
        for q, begin, end in zip(index[touched].tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
            first = begin + self._first(values[begin:end])
            self._merge(q, values[first], ids[cols[first]])

    def _first(self, values: np.ndarray) -> np.ndarray:
        """Places of the k largest values, the first of equal ones: all rows of a corpus may be equally far from a question."""
        if len(values) <= self.k:
            return np.arange(len(values))
        bar = np.partition(values, len(values) - self.k)[len(values) - self.k]
        above = np.flatnonzero(values > bar)
        return np.concatenate([above, np.flatnonzero(values == bar)[: self.k - len(above)]])

    def _squares(self, block, corpus, rows: np.ndarray, cols: np.ndarray, dots: np.ndarray) -> np.ndarray:
        """Squared distances. Only a pair close together, whose product cancels the lengths, needs the gaps of its values."""
        lengths = block.squares[rows] + corpus.squares[cols]
        square = lengths - 2 * dots[rows, cols]
        close = np.flatnonzero(square < CLOSE * lengths)
        square[close] = self._exact(block, corpus, rows[close], cols[close])
        return square

    def _exact(self, block, corpus, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        step = max(1, CELL_SCORES // block.width)
        parts = [
            block.exact_square(corpus, rows[a : a + step], cols[a : a + step]) for a in range(0, len(rows), step)
        ]
        return np.concatenate(parts) if parts else np.empty(0)

    def _merge(self, q: int, values: np.ndarray, ids: np.ndarray) -> None:
        if self.kept[q] is not None:
            values = np.concatenate([self.kept[q][0], values])
            ids = np.concatenate([self.kept[q][1], ids])
        order = np.lexsort((ids, -values))[: self.k]
        self.kept[q] = (values[order], ids[order])
        if len(order) == self.k:
            self.floor[q] = values[order[-1]]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Question positions, corpus ids, scores."""
        filled = [(q, *kept) for q, kept in enumerate(self.kept) if kept is not None]
        if not filled:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        positions = np.concatenate([np.full(len(v), q) for q, v, _ in filled])
        scores = np.concatenate([v for _, v, _ in filled])
        return positions, np.concatenate([i for _, _, i in filled]), scores


def _hits(best: _Best, qids: pa.Array, id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    positions, ids, scores = best.rows()
    if id_type == pa.string():
        out_ids = pa.array([i.decode() for i in ids.tolist()], pa.string())
    else:
        out_ids = pa.array(ids, id_type)
    if best.metric == "l2":
        scores = -scores + 0.0
    return pa.RecordBatch.from_arrays([qids.take(pa.array(positions)), out_ids, pa.array(scores)], names)


def _combined(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def nearest(
    corpus: DataFrame,
    questions: DataFrame,
    k: int = 4,
    metric: str = "cosine",
    corpus_id: str = "id",
    question_id: str = "qid",
    corpus_vector: str = "embedding",
    question_vector: str = "embedding",
    score: str = "score",
    dim: int | None = None,
    way: str = "auto",
    skip_same_id: bool = False,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every question: ``question_id, corpus_id, rk, score``.

    ``metric`` is ``cosine`` (similarity), ``l2`` (distance, smallest first) or ``relevance``
    (1 - d^2 / sqrt 2). Vectors are numeric arrays, or ``array<struct<bucket, weight>>`` below ``dim``.
    Null ids and vectors match nothing, nor do zero vectors under cosine. Ids must be unique per side and have
    different column names. ``way`` forces ``scan`` or ``grid``; ``auto`` scans only if the questions
    are proven to fit. ``skip_same_id`` leaves out the corpus row with the question's own id, for a table
    searched with its own rows.
    """
    if metric not in METRICS or way not in ("auto", "scan", "stream", "grid"):
        raise ValueError(f"unknown metric {metric!r} or way {way!r}")
    if k < 1 or corpus_id == question_id:
        raise ValueError("k must be at least 1 and the id columns must differ")
    left = questions.select(F.col(question_id).alias("qid"), F.col(question_vector).alias("v"))
    right = corpus.select(F.col(corpus_id).alias("id"), F.col(corpus_vector).alias("v"))
    left, right = left.dropna(subset=["qid", "v"]), right.dropna(subset=["id", "v"])
    q_type, c_type = _id_type(left.schema["qid"].dataType), _id_type(right.schema["id"].dataType)
    sparse = isinstance(right.schema["v"].dataType.elementType, T.StructType)
    if sparse and dim is None:
        raise ValueError("sparse vectors need dim")
    left = left.select(F.col("qid").cast("string" if q_type == pa.string() else "bigint").alias("qid"), "v")
    right = right.select(F.col("id").cast("string" if c_type == pa.string() else "bigint").alias("id"), "v")

    small = _small_side(left) if way in ("auto", "scan") else None
    if small is None and way == "scan":
        raise ValueError("the question side exceeds the bound of the scan way")
    names = ["qid", "id", "score"]
    kept = k + 1 if skip_same_id else k  # ids are unique, so at most one of the kept rows is left out
    schema = T.StructType(
        [
            T.StructField("qid", left.schema["qid"].dataType),
            T.StructField("id", right.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def vectors(column: pa.Array):
        return _Sparse(column, dim) if sparse else _Dense(column)

    def prepared(table: pa.Table) -> tuple[pa.Array, object]:
        qids, rows = _combined(table.column("qid")), vectors(_combined(table.column("v")))
        if metric == "cosine":
            keep = np.flatnonzero(rows.squares > 0)
            qids, rows = qids.take(pa.array(keep)), rows.take(keep)
        return qids, rows

    if small is not None:
        shared = corpus.sparkSession.sparkContext.broadcast(small)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, rows = prepared(shared.value)
            best = _Best(rows, kept, metric)
            for batch in batches:
                best.add(_ids(batch.column(0)), vectors(batch.column(1)))
            yield _hits(best, qids, c_type, names)

        found = right.mapInArrow(scan, schema)
    elif (asked := _shared(left, way)) is not None:

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, object]] = []
            values = 0

            def past() -> Iterator[pa.RecordBatch]:
                for block in asked.batches(["qid", "v"], STREAM_QUESTIONS):
                    qids, rows = prepared(pa.Table.from_batches([block]))
                    best = _Best(rows, kept, metric)
                    for ids, part in held:
                        best.add(ids, part)
                    yield _hits(best, qids, c_type, names)

            for batch in batches:
                held.append((_ids(batch.column(0)), vectors(batch.column(1))))
                values += len(batch.column(1).flatten())
                if values > STREAM_VALUES:
                    yield from past()
                    held, values = [], 0
            if held:
                yield from past()

        found = right.mapInArrow(stream, schema)
    else:
        # Block counts come from row counts, so that blocks stay bounded at any size.
        q_blocks = max(1, math.ceil(left.count() / GRID_QUESTIONS))
        c_blocks = max(1, math.ceil(right.count() / GRID_CORPUS))

        def every(blocks: int):
            return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

        left = left.select(
            F.pmod(F.xxhash64("qid"), F.lit(q_blocks)).cast("int").alias("qb"), every(c_blocks).alias("cb"), "qid", "v"
        )
        right = right.select(
            every(q_blocks).alias("qb"), F.pmod(F.xxhash64("id"), F.lit(c_blocks)).cast("int").alias("cb"), "id", "v"
        )

        def cell(questions_part: pa.Table, corpus_part: pa.Table) -> pa.Table:
            if not questions_part.num_rows or not corpus_part.num_rows:
                return schema_of.empty_table()
            qids, rows = prepared(questions_part)
            best = _Best(rows, kept, metric)
            step = 8192
            for begin in range(0, corpus_part.num_rows, step):
                part = corpus_part.slice(begin, step)
                best.add(_ids(_combined(part.column("id"))), vectors(_combined(part.column("v"))))
            return pa.Table.from_batches([_hits(best, qids, c_type, names)])

        schema_of = pa.schema([("qid", q_type), ("id", c_type), ("score", pa.float64())])
        keys = ("qb", "cb")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, schema)

    if skip_same_id:
        found = found.where(F.col("qid") != F.col("id"))
    better = F.col("score").asc() if metric == "l2" else F.col("score").desc()
    wide = corpus.sparkSession.sparkContext.defaultParallelism > WIDE_CLUSTER
    ranked = top_k(found, ["qid"], [better, F.col("id").asc()], k, wide=wide).select(
        F.col("qid").alias(question_id), F.col("id").alias(corpus_id), "rk", F.col("score").alias(score)
    )
    if small is not None and small.num_rows * k <= BROADCAST_HITS:
        # Fetching the hits' content then reads the corpus without shuffling it.
        return F.broadcast(ranked)
    return ranked


def _shared(left: DataFrame, way: str) -> SharedParquet | None:
    """The questions in the shared folder, if Python tasks can open it; None for the grid."""
    if way == "grid":
        return None
    root = scratch_path(left.sparkSession, "questions")
    left.write.parquet(root)
    if readable(root):
        return SharedParquet(root)
    if way == "stream":
        raise ValueError(f"Python cannot open {root}")
    return None


def _small_side(left: DataFrame) -> pa.Table | None:
    """The questions as one table if they are within both bounds, else None; reads at most the bound."""
    # Sizes first, partition by partition up to the bound: an oversized side is never brought here.
    sizes = left.select(F.array_size("v").alias("n")).take(SCAN_ROWS + 1)
    if len(sizes) > SCAN_ROWS or sum(r.n for r in sizes) > SCAN_VALUES:
        return None
    return left.toArrow()
