"""Embedding whitening by shifted CholeskyQR.

Vectors become whole numbers, and the model is fitted on the different ones among them. With ``n`` of them and their sums ``S``, ``n x
- S`` is exact, so centred rows ``(n x - S) / n`` are right to the last bit however far the values lie from zero. The
centred rows are the matrix ``A``. A pass forms the Gram matrix of ``A R^-1`` by a triangular solve in every task; its Cholesky
factor is multiplied onto ``R``, so ``A = Q R`` with ``Q`` ever closer to orthogonal. The first pass shifts the diagonal by the rounding
error that a Gram matrix of this size can have, so it succeeds at any condition; later ones do so only where the factorisation
breaks down. Passes end when the Gram matrix is the identity to ``CLOSE``. As ``Q`` is orthogonal, the singular vectors
of the small ``R`` are the components, and its singular values over ``sqrt(n)`` their standard deviations; the covariance itself, whose
condition is that of ``R`` squared, is never decomposed.

A task gives one row of numbers for each dimension, which are added up by dimension; only matrices of ``length * length`` reach the
driver, and ``length`` is at most ``MOST_LENGTH``. The different vectors are found by one pre-aggregated shuffle, so a vector that a third of
all rows hold is one row a task, and written once for all passes.

Nulls and odd input: rows without a vector or with a null, NaN or infinite entry take no part. Of vectors of different lengths those
of the commonest length count (the longer of equals). A null id is an id like any other; repeated rows are answered each. A
direction without variance has no component, so constant or dependent dimensions give fewer; a single different vector, or none, gives
no rows. Other columns are ignored. ``deviation`` is a decimal of 38 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm.vectors import common_length, finite, matrices, whole_steps
from passagework.session import stage

FACTOR, SHIFT = 64, 1_000_000
COMPONENTS = 16
MOST_LENGTH = 8_192
CLOSE = 1e-11
PASSES = 8


@dataclass(frozen=True)
class Whitening:
    """``n`` different vectors, their exact sums, and a column of ``directions`` with its ``deviations`` for each component."""

    n: int
    sums: list[int]
    largest: int
    directions: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    def exact(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``; in Python's integers where 64 bits could be too few."""
        if self.n * self.largest < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.exact(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """The squared length of ``n x - S``, exact."""
        d = self.exact(x)
        if d.dtype != object and len(d) and float(np.abs(d).max()) ** 2 * d.shape[1] >= 2.0**62:
            d = d.astype(object)
        return (d * d).sum(axis=1)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / self.deviations


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows R^-1`` of an upper triangular ``R``, column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _sums(fit: DataFrame, length: int) -> tuple[int, list[int], int]:
    """The number of vectors, their sums and the largest absolute entry, all exact."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, largest = [0] * length, 0, 0
        for batch in batches:
            for _, x in matrices(batch, "x", length):
                largest = max(largest, abs(int(x.max())), abs(int(x.min())))
                # halves of 32 bits cannot overflow when added up
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high, low)]
                n += len(x)
        if n:
            columns = [pa.array(range(length), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * length, pa.int64()), pa.array([largest] * length, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["i", "total", "n", "largest"])

    parts = fit.mapInArrow(task, "i int, total string, n bigint, largest bigint")
    added = parts.groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"), F.max("largest").alias("m"))
    rows = sorted(added.collect())
    return (rows[0]["n"], [int(r["s"]) for r in rows], rows[0]["m"]) if rows else (0, [], 0)


def _gram(fit: DataFrame, length: int, make: Callable[[np.ndarray], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The Gram matrix and the sums of the rows that ``make`` turns vectors into, ``width`` numbers each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width + 1, width))
        seen = False
        for batch in batches:
            for _, x in matrices(batch, "x", length):
                made = make(x)
                gram[:width] += made.T @ made
                gram[width] += made.sum(axis=0)
                seen = True
        if seen:
            part = TaskContext.get().partitionId()
            columns = [pa.array(range(width + 1), pa.int32()), pa.array([part] * (width + 1), pa.int32()), pa.array(gram.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "part", "of"])

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")  # the same order of addition in every run
        values = group.column("of").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, width)
        return pa.table({"i": group.column("i")[:1], "of": pa.array([values.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    parts = fit.mapInArrow(task, "i int, part int, of array<double>")
    rows = sorted(parts.groupBy("i").applyInArrow(add, "i int, of array<double>").collect())
    whole = np.array([r["of"] for r in rows])
    return whole[:width], whole[width]


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper Cholesky factor; where it breaks down the diagonal is shifted, ever further."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, len(gram) * np.finfo(float).eps * np.trace(gram))


def whole_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` without the rows that take no part, and the whole numbers of the others as ``x``."""
    return vectors.where(finite(F.col(vector))).withColumn("x", whole_steps(F.col(vector), FACTOR, SHIFT))


def different_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The different ``x`` of the commonest length, written once for all passes, and that length."""
    length = common_length(vectors, "x")
    if length > MOST_LENGTH:
        raise ValueError(f"vectors of {length} entries; the matrices on the driver hold {MOST_LENGTH} at most")
    return stage(vectors.where(F.size("x") == length).select("x").distinct(), "vectors"), length


def fit(different: DataFrame, length: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors; None without variance."""
    if not length:
        return None
    n, sums, largest = _sums(different, length)
    if n < 2:
        return None
    plain = Whitening(n, sums, largest, np.eye(length), np.ones(length), np.ones(length))
    r, eps = np.eye(length), np.finfo(float).eps
    for number in range(PASSES):
        make = (lambda x, r=r: solve(plain.centred(x), r)) if number else plain.centred
        gram, _ = _gram(different, length, make, length)
        shift = 0.0 if number else 11 * (n * length + length * (length + 1)) * eps * np.trace(gram)
        r = _factor(gram, min(shift, np.trace(gram) / length)) @ r
        if np.abs(gram - np.eye(length)).max() <= CLOSE:
            break
    _, spread, directions = np.linalg.svd(r)
    top = np.flatnonzero(spread > spread[0] * length * eps)[:components]
    variance = spread**2
    return Whitening(n, sums, largest, directions[top].T.copy(), spread[top] / np.sqrt(n), variance[top] / variance.sum())


def identity_error(different: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    width = len(model.deviations)
    gram, sums = _gram(different, len(model.sums), model.whiten, width)
    mean = sums / model.n
    return float(np.abs(gram / model.n - np.outer(mean, mean) - np.eye(width)).max())


def _decimal(values: np.ndarray) -> pa.Array:
    kind = pa.decimal128(38, 0)
    return pa.array(values.tolist(), kind) if values.dtype == object else pa.array(values).cast(kind)


def whiten(vectors: DataFrame, model: Whitening, row_id: str = "vec_id") -> DataFrame:
    """``row_id, component, n, deviation, whitened, explained`` of every row and component."""
    length, width = len(model.sums), len(model.deviations)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, x in matrices(batch, "x", length):
                ids = batch.column(0).slice(start, len(x)).take(pa.array(np.repeat(np.arange(len(x)), width)))
                columns = [
                    ids, pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))), pa.array(np.full(len(ids), model.n)),
                    _decimal(np.repeat(model.deviation(x), width)), pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                ]
                yield pa.RecordBatch.from_arrays(columns, [row_id, "component", "n", "deviation", "whitened", "explained"])

    kind = vectors.schema[row_id].dataType.simpleString()
    schema = f"`{row_id}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double"
    return vectors.where(F.size("x") == length).select(row_id, "x").mapInArrow(task, schema)


def whitened_vectors(vectors: DataFrame, row_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``whiten`` of the table's own model, and the model's ``identity_error``."""
    whole = whole_vectors(vectors.select(row_id, vector), vector)
    different, length = different_vectors(whole)
    model = fit(different, length, components)
    if model is None:
        kind = vectors.schema[row_id].dataType.simpleString()
        schema = f"`{row_id}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    return whiten(whole, model, row_id).withColumn("identity_error", F.lit(identity_error(different, model)))
