"""Quality classifier: a generalised additive model with pairwise interactions.

Features are shape statistics of a whole text, cut into quantile bins. Boosting goes round the features in turn; each
visit fits a tree of at most three leaves to the gradient by bin and adds a small step to that feature's lookup table.
Then the pairs with the largest gain left get tables of their own from trees with one cut on either feature. A score is
the sigmoid of table entries added up, a few vectorised look-ups a batch. The model is fitted on the driver on at most
``rows`` labelled documents (a documented bound), of which only the features are collected, and is bounded by bins and
features.

Nulls and odd input: a null text is an empty one, whose features are 0 and which is scored like any other. Without
labels, or with one class only, the score is the smoothed mean of the labels. Repeated rows score alike. Other columns
are carried along.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.labelled import held_out, training_rows

MODULO, REST = 3, 1
ROWS = 10_000
BINS = 32
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, RIDGE, LEAST = 0.15, 1.0, 10

FEATURES = [
    "log_words", "log_bytes", "word_length", "letters", "upper", "digits", "punctuation", "symbols", "bars", "lines_per_word",
    "distinct_words", "top_word", "one_byte_words", "symbol_ends", "repeated_lines", "letter_entropy", "spread_of_lengths",
]
_CLASS = np.zeros(256, np.int64)  # 0 other and beyond ASCII, 1 lower, 2 upper, 3 digit, 4 punctuation, 5 symbol, 6 blank
for _set, _c in (
    (b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b".,;:!?\"'()-", 4),
    (b"#*$%&|<>@^~=+_/\\[]{}`", 5), (b" \t\n\x0b\x0c\r", 6),
):
    _CLASS[list(_set)] = _c
_SYMBOLS = tuple("#*$%&|<>@^~=+_/\\[]{}`")


def features(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, raw, 7)
    full, n = max(1.0, kinds[:6].sum()), len(words)
    counts, lengths = Counter(words), np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split("\n") if x]
    p = raw[97:123] / max(1, raw[97:123].sum())
    return [
        np.log1p(n), np.log1p(full), lengths.mean(), (kinds[0] + kinds[1] + kinds[2]) / full, kinds[2] / full,
        kinds[3] / full, kinds[4] / full, kinds[5] / full, raw[124] / n, len(lines) / n, len(counts) / n,
        max(counts.values()) / n, (lengths == 1).mean(), sum(w.endswith(_SYMBOLS) for w in words) / n,
        1 - len(set(lines)) / max(1, len(lines)), float(-(p[p > 0] * np.log(p[p > 0])).sum()), lengths.std(),
    ]


def _cuts(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf values by bin of the best tree with at most three leaves."""
    leaf = np.zeros(len(g), int)
    for new in (1, 2):
        best = (1e-9, None, None)
        for old in range(new):
            at = np.flatnonzero(leaf == old)
            G, H, N = (np.cumsum(x[at]) for x in (g, h, n))
            if len(at) < 2:
                continue
            left = G[:-1] ** 2 / (H[:-1] + RIDGE) + (G[-1] - G[:-1]) ** 2 / (H[-1] - H[:-1] + RIDGE) - G[-1] ** 2 / (H[-1] + RIDGE)
            left = np.where((N[:-1] >= LEAST) & (N[-1] - N[:-1] >= LEAST), left, 0)
            if left.max() > best[0]:
                best = (left.max(), at, int(left.argmax()))
        if best[1] is None:
            break
        leaf[best[1][best[2] + 1 :]] = new
    G, H = (np.bincount(leaf, x, 3) for x in (g, h))
    return (G / (H + RIDGE))[leaf]


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on either axis of two-way bins."""
    G, H = (x.cumsum(0).cumsum(1) for x in (g, h))

    def four(x: np.ndarray) -> np.ndarray:
        a, row, column, all_ = x[:-1, :-1], x[:-1, -1:], x[-1:, :-1], x[-1, -1]
        return np.stack([a, row - a, column - a, all_ - row - column + a])

    G, H = four(G), four(H)
    gain = (G**2 / (H + RIDGE)).sum(0)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    value = G[:, i, j] / (H[:, i, j] + RIDGE)
    below, left = np.arange(g.shape[0])[:, None] <= i, np.arange(g.shape[1])[None, :] <= j
    return float(gain.max()), np.where(below, np.where(left, value[0], value[1]), np.where(left, value[2], value[3]))


@dataclass(frozen=True)
class Model:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = self.intercept + sum(t[b[:, j]] for j, t in enumerate(self.tables))
        for (i, j), t in self.pairs.items():
            z = z + t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base, x = float(np.log(rate / (1 - rate))), x.reshape(-1, len(FEATURES))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for c in x.T]
    model = Model(base, edges, [np.zeros(len(e) + 1) for e in edges], {})
    if not 0 < y.sum() < len(y):
        return model
    b, z = model.bins(x), np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _cuts(*(np.bincount(b[:, j], v, len(table)) for v in (g, h, np.ones_like(g))))
            table += step
            z = z + step[b[:, j]]
    shape = lambda i, j: (len(model.tables[i]), len(model.tables[j]))

    def table_of(i: int, j: int, v: np.ndarray) -> np.ndarray:
        a, c = shape(i, j)
        return np.bincount(b[:, i] * c + b[:, j], v, a * c).reshape(a, c)

    g, h = slopes()
    ranked = sorted(
        ((_quarters(table_of(i, j, g), table_of(i, j, h))[0], i, j) for i in range(len(edges)) for j in range(i) if min(shape(i, j)) > 1),
        reverse=True,
    )
    for _, i, j in ranked[:PAIRS]:
        model.pairs[i, j] = np.zeros(shape(i, j))
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in model.pairs.items():
            g, h = slopes()
            step = RATE * _quarters(table_of(i, j, g), table_of(i, j, h))[1]
            table += step
            z = z + step[b[:, i], b[:, j]]
    return model


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _measured(text: pd.Series) -> pd.Series:
    return pd.Series([features(t) for t in text])


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    sample = training_rows(docs, labels, "quality", MODULO, REST, rows)
    sample = sample.select(_measured("text").alias("x"), "y").toPandas()
    data = np.array([*map(list, sample["x"])], float).reshape(-1, len(FEATURES))
    y = sample["y"].to_numpy(float)
    order = np.lexsort([*data.T, y])  # rows come in no order
    return fit(data[order], y[order])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(text: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in text], float).reshape(-1, len(FEATURES))
        return pd.Series(held.value.score(x))

    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")]
    out = docs.withColumn("__score", scored("text"))
    return out.select(
        *carried,
        held_out(F.col("doc_id"), MODULO, REST).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )
