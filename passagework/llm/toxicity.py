"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores ``sigmoid(bias + weights of its distinct words)``, where a word weighs
by itself and by its beginnings, and a document is toxic if any sentence is: the noisy-or ``1 - prod(1 - sentence)``. Only documents have labels; the gradient of the
noisy-or tells which sentences they speak of, so the model also locates them.

It is fitted on a sample of at most ``ROWS`` labelled documents of ``CHARS`` characters together (documented bounds; each enters whole).
Tasks count in how many of them every feature is, and in how many toxic ones; the ``FEATURES`` that toxic ones hold most beyond
chance, in ``MIN_DOCS`` toxic ones at least, are the vocabulary. Tasks then turn texts into the numbers of their features, and the driver
gets only those. The model is a table of weights bounded by the vocabulary, which every task gets. All texts are scored whole, in Arrow batches.

Nulls and odd input: a null or blank text has no sentence and scores 0. Without labels, or with one class only, the
score is 0 for all (no positive label) or follows the bias. Repeated rows are scored alike. Other columns are carried
along by ``score`` and ``clean``; ``score`` replaces columns that have its results' names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.labelled import held_out, training_rows
from passagework.session import stage

MODULO, REST = 5, 0
ROWS = 8_000
CHARS = 64_000_000
MIN_DOCS = 4
FEATURES = 20_000
PARTITIONS = 32
BEGINNINGS = range(3, 9)
STEPS = 100
RIDGE = 0.1
TOXIC_WEIGHT = 2.0
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
_EDGE = ".,;:!?\"'()[]{}<>|#*$%&-_"
_OUT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("sentences", T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("score", T.DoubleType())]))),
    ]
)


def sentences(text: str | None) -> list[set[str]]:
    """The distinct words of each sentence: lower case, without punctuation at the ends. Sentences without a word count
    too, so a place is a place in the split text."""
    return [{w for x in s.lower().split() if (w := x.strip(_EDGE))} for s in _SENTENCE.split(text or "")]


def parts(word: str) -> list[str]:
    """A word's features: itself, and its beginnings of three to eight letters."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if n <= len(word))]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def __post_init__(self) -> None:
        self._known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """The word's weight, remembered for a bounded number of words."""
        value = self._known.get(word)
        if value is None:
            if len(self._known) > 200_000:
                self._known.clear()
            value = self._known[word] = sum(self.weights.get(f, 0.0) for f in parts(word))
        return value

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float]]]:
        """The document's probability, and the places and probabilities of the sentences at 0.5 or more."""
        total, each = 0.0, []
        for place, words in enumerate(sentences(text)):
            if words:
                z = self.bias + sum(map(self.weight, words))
                total += math.log1p(math.exp(z)) if z < 30 else z
                if z >= 0:
                    each.append((place, 1 / (1 + math.exp(-z))))
        return -math.expm1(-total), each


def feature_counts(texts: Iterable[str | None], labels: Iterable[int]) -> dict[str, list[int]]:
    """Of every feature, the documents and the toxic documents that hold it."""
    counts: dict[str, list[int]] = {}
    for text, label in zip(texts, labels):
        for f in {f for w in set().union(*sentences(text)) for f in parts(w)}:
            n = counts.setdefault(f, [0, 0])
            n[0] += 1
            n[1] += label
    return counts


def encode(text: str | None, vocabulary: dict[str, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of sentences without a known feature; of the others, the features' numbers and how many each has."""
    plain, feature, sizes = 0, [], []
    for words in filter(None, sentences(text)):
        own = sorted(vocabulary[f] for w in words for f in parts(w) if f in vocabulary)
        feature += own
        sizes += [len(own)] if own else []
        plain += not own
    return plain, np.array(feature, np.int32), np.array(sizes, np.int32)


def learn(
    encoded: list[tuple[int, np.ndarray, np.ndarray]], labels: list[int], vocabulary: list[str],
    steps: int = STEPS, ridge: float = RIDGE, toxic_weight: float = TOXIC_WEIGHT,
) -> Model:
    """Adam on the mean log loss of the noisy-or, with a ridge on the weights.

    Weights stay at 0 or above: a word can speak for toxicity but not hide another's. Sentences without a feature count by their number.
    """
    used = [(e, y) for e, y in zip(encoded, labels) if e[0] or len(e[2])]
    y = np.array([u[1] for u in used], float)
    if not y.any():
        return Model({}, -50.0)
    plain = np.array([u[0][0] for u in used], float)
    feature = np.concatenate([u[0][1] for u in used])
    sizes = np.concatenate([u[0][2] for u in used])
    n_docs, n_sentences, n_features = len(used), len(sizes), len(vocabulary)
    of_sentence = np.repeat(np.arange(n_sentences, dtype=np.int32), sizes)
    of_doc = np.repeat(np.arange(n_docs), [len(u[0][2]) for u in used])
    w = np.zeros(n_features + 1)
    w[-1] = np.log(max(y.mean(), 1e-6)) - np.log((n_sentences + plain.sum()) / n_docs)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.clip(w[-1] + np.bincount(of_sentence, w[feature], n_sentences), -30, 30)
        bias = np.clip(w[-1], -30, 30)
        p = 1 / (1 + np.exp(-z))
        left = np.bincount(of_doc, np.logaddexp(0, z), n_docs) + plain * np.logaddexp(0, bias)
        pull = np.where(y == 1, -toxic_weight / np.maximum(np.expm1(left), 1e-9), 1.0) / n_docs
        dz = pull[of_doc] * p
        by_feature = np.bincount(feature, dz[of_sentence], n_features) + ridge / n_docs * w[:-1]
        g = np.append(by_feature, dz.sum() + (pull * plain).sum() / (1 + np.exp(-bias)))
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= 0.1 * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w[:-1] = np.maximum(w[:-1], 0)
    return Model({v: float(x) for v, x in zip(vocabulary, w[:-1]) if x != 0}, float(w[-1]))


def beyond_chance(n, toxic, rate: float):
    """How far the toxic documents of a feature exceed the expected ones, in deviations; of numbers or columns."""
    return (toxic - rate * n) / (rate * n + 1) ** 0.5


def fit(texts: list[str | None], labels: list[int]) -> Model:
    """A model of local lists, by the same steps as ``train``."""
    rate = sum(labels) / max(1, len(labels))
    known = [(-beyond_chance(n, t, rate), f) for f, (n, t) in feature_counts(texts, labels).items() if t >= MIN_DOCS and t > rate * n]
    vocabulary = [f for _, f in sorted(known)[:FEATURES]]
    numbers = {f: i for i, f in enumerate(vocabulary)}
    return learn([encode(t, numbers) for t in texts], labels, vocabulary)


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS, chars: int = CHARS) -> Model:
    spark = docs.sparkSession
    sample = stage(training_rows(docs, labels, "toxic", MODULO, REST, rows, chars).repartition(PARTITIONS, F.xxhash64("text")), "toxicity-sample")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            counts = feature_counts(f["text"], f["y"])
            yield pd.DataFrame([(k, *v) for k, v in counts.items()], columns=["feature", "n", "toxic"])

    rate = sample.agg(F.avg("y")).first()[0] or 0.0
    counts = sample.mapInPandas(count, "feature string, n bigint, toxic bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    known = counts.where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") > F.lit(rate) * F.col("n")))
    order = [F.desc("excess"), "feature"]
    known = known.select("feature", beyond_chance(F.col("n"), F.col("toxic"), rate).alias("excess")).orderBy(*order).limit(FEATURES)
    vocabulary = [r.feature for r in known.collect()]  # FEATURES at most
    held = spark.sparkContext.broadcast({f: i for i, f in enumerate(vocabulary)})

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            each = [(y, plain, own.tobytes(), sizes.tobytes()) for y, (plain, own, sizes) in zip(f["y"], (encode(t, held.value) for t in f["text"]))]
            yield pd.DataFrame(each, columns=["y", "plain", "own", "sizes"])

    coded = sample.mapInPandas(code, "y int, plain bigint, own binary, sizes binary").toPandas()
    coded = coded.sort_values(["own", "sizes", "plain", "y"], kind="stable")  # rows come in no order
    encoded = [(p, np.frombuffer(o, np.int32), np.frombuffer(s, np.int32)) for p, o, s in zip(coded["plain"], coded["own"], coded["sizes"])]
    return learn(encoded, coded["y"].tolist(), vocabulary)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``predicted`` and the offending ``sentences``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(_OUT)
    def scored(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held.value.score(t) for t in text], columns=["score", "sentences"])

    out = docs.withColumn("__s", scored("text"))
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted", "sentences")]
    return out.select(
        *carried,
        held_out(F.col("doc_id"), MODULO, REST).alias("held_out"),
        F.col("__s.score").alias("score"),
        (F.col("__s.score") >= 0.5).cast("int").alias("predicted"),
        F.col("__s.sentences").alias("sentences"),
    )


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted to be toxic, with their own columns."""
    kept = score(docs.withColumn("__row", F.struct(*(F.col(f"`{c}`") for c in docs.columns))), model).where("predicted = 0")
    return kept.select("__row.*")
