"""Batch scoring with pluggable functions, joins of scores to inputs, and the offline stand-ins."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.functions.templates import render
from passagework.functions.text import bind, sentences, token_count, tokens
from passagework.operators.ranking import top_k
from passagework.operators.rows import compute_once


@dataclass(frozen=True)
class Scorer:
    """A scoring function with its contract.

    ``load`` runs once per task and returns ``lists of input columns -> list of outputs``; ``inputs``
    lists the types it takes and ``output`` the type it returns.
    """

    name: str
    load: Callable[[], Callable[..., Sequence]]
    inputs: tuple[T.DataType, ...] = (T.StringType(),)
    output: T.DataType = T.StringType()

    def check(self, df: DataFrame, columns: Sequence[str]) -> None:
        """Fail before the job starts if the columns do not meet the contract."""
        if len(columns) != len(self.inputs):
            raise ValueError(f"{self.name} takes {len(self.inputs)} columns, not {len(columns)}")
        for column, wanted in zip(columns, self.inputs):
            found = df.schema[column].dataType
            if found != wanted:
                raise TypeError(f"{self.name} wants {wanted.simpleString()} for {column!r}, not {found.simpleString()}")


def batch_score(df: DataFrame, scorer: Scorer, columns: Sequence[str], out: str) -> DataFrame:
    """Add ``out``, computed batch by batch. Only the input columns travel to Python.

    Rows whose first input is null get null and are not scored.
    """
    scorer.check(df, columns)
    load, name, arrow_type = scorer.load, scorer.name, _arrow_type(scorer.output)

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        score = load()
        for batch in batches:
            lists = [c.to_pylist() for c in batch]
            live = [i for i, v in enumerate(lists[0]) if v is not None]
            results = list(score(*([c[i] for i in live] for c in lists))) if live else []
            if len(results) != len(live):
                raise ValueError(f"{name} returned {len(results)} results for {len(live)} rows")
            values = [None] * len(lists[0])
            for i, value in zip(live, results):
                values[i] = value
            yield pa.array(values, arrow_type)

    def run_one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run((b,) for b in batches)

    udf = F.arrow_udf(run_one if len(columns) == 1 else run, scorer.output)
    return df.withColumn(out, udf(*(F.col(c) for c in columns)))


def batch_score_by_length(df: DataFrame, scorer: Scorer, key: str, text: str, out: str, budget: int) -> DataFrame:
    """``key, out`` of every row, in batches of like length.

    A model pads a batch to its longest text, so a batch costs its rows times the tokens of that text. Rows are ordered by length
    within their partition, without a shuffle, and a batch is closed before it would cost more than ``budget`` tokens; a
    longer text stands alone. Null texts get null and are not scored. Keys may repeat.
    """
    scorer.check(df, [text])
    load, name, arrow_type = scorer.load, scorer.name, _arrow_type(scorer.output)
    counted = df.select(key, text, F.coalesce(token_count(F.col(text)), F.lit(0)).alias("__n")).sortWithinPartitions("__n")
    schema = T.StructType([df.select(key).schema[0], T.StructField(out, scorer.output)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = load()
        keys: list[pa.Array] = []
        texts: list[str] = []

        def close() -> pa.RecordBatch:
            results = list(score(texts))
            if len(results) != len(texts):
                raise ValueError(f"{name} returned {len(results)} results for {len(texts)} rows")
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), pa.array(results, arrow_type)], [key, out])

        for batch in batches:
            for i, (value, n) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                own = batch.column(0).slice(i, 1)
                if value is None:
                    yield pa.RecordBatch.from_arrays([own, pa.nulls(1, arrow_type)], [key, out])
                    continue
                if texts and (len(texts) + 1) * max(n, 1) > budget:
                    yield close()
                    keys, texts = [], []
                keys.append(own)
                texts.append(value)
        if texts:
            yield close()

    return counted.mapInArrow(run, schema)


def _arrow_type(data_type: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(data_type)


def prompt_and_score(df: DataFrame, template: str, scorer: Scorer, values: dict[str, Column], out: str) -> DataFrame:
    """Render a prompt per row and score it; the prompt itself is not kept."""
    prompted = df.withColumn("__prompt", render(template, values))
    return batch_score(prompted, scorer, ["__prompt"], out).drop("__prompt")


def join_scores(inputs: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Put scores beside their inputs by key. Every input stays, scored or not."""
    return inputs.join(scored, key, "left")


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a column that must exist, to a name that must be free."""
    if old not in df.columns or (new in df.columns and new != old):
        raise ValueError(f"cannot rename {old!r} to {new!r} among {df.columns}")
    return df.withColumnRenamed(old, new)


def extractive_summary(df: DataFrame, key: str, text_col: str, out: str = "model_summary") -> DataFrame:
    """One sentence per text as its summary; a stand-in for a summarisation model.

    A sentence scores the sum of its tokens' counts in the whole text; the earliest of the best wins.
    All of it happens inside the row, so nothing is shuffled and ``key`` may repeat. Returns ``key, out,
    summary_score`` for every row; both are null where a text has no token.
    """
    scored = compute_once(df, [key, text_col], __best=_best_by_counts(F.col(text_col)))
    sentence = F.get(sentences(F.col(text_col)), F.col("__best.pos"))
    return scored.select(key, sentence.alias(out), F.col("__best.score").alias("summary_score"))


def _runs(sorted_: Column, field: str, use: Callable[[Column], Column]) -> Column:
    """``use`` of each run of structs that agree in ``field``, in order; the array is sorted and not empty."""

    def starts(x: Column) -> Column:
        places = F.sequence(F.lit(0), F.array_size(x) - 1)
        return F.filter(places, lambda k: F.coalesce(F.get(x, k)[field] != F.get(x, k - 1)[field], F.lit(True)))

    def cut(x: Column) -> Column:
        def each(at: Column) -> Column:
            end = lambda r: F.coalesce(F.get(at, r + 1), F.array_size(x))
            return F.transform(at, lambda k, r: bind(F.slice(x, k + 1, end(r) - k), use))

        return bind(starts(x), each)

    return bind(sorted_, cut)


def _best_by_counts(text: Column) -> Column:
    """``score, pos`` of the sentence whose tokens occur most often in the text; null without a token."""

    def placed(sentence: Column, pos: Column) -> Column:
        return F.transform(tokens(sentence), lambda w: F.struct(w.alias("word"), pos.alias("pos")))

    def counted(run: Column) -> Column:
        n = F.array_size(run).cast("bigint")
        return F.transform(run, lambda x: F.struct(x["pos"].alias("pos"), n.alias("n")))

    def total(run: Column) -> Column:
        score = F.aggregate(run, F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])
        pos = F.get(run, F.lit(0))["pos"]
        return F.struct(score.alias("score"), (-pos).alias("order"), pos.alias("pos"))

    def best(words: Column) -> Column:
        by_sentence = F.sort_array(F.flatten(_runs(F.sort_array(words), "word", counted)))
        return F.when(F.array_size(words) > 0, F.array_max(_runs(by_sentence, "pos", total)))

    return bind(F.flatten(F.transform(sentences(text), placed)), best)


def best_sentence(context: Column, question: Column) -> Column:
    """The context's sentence sharing most distinct tokens with the question, the first of equals.

    A stand-in for a model's answer; null if the context has no sentence. Contexts are bounded by
    the k chunks they are made of.
    """

    def pick(wanted: Column) -> Column:
        def scored(sentence: Column, position: Column) -> Column:
            shared = F.array_size(F.array_intersect(tokens(sentence), wanted))
            return F.struct(shared.alias("shared"), (-position).alias("order"), sentence.alias("sentence"))

        return F.array_max(F.transform(sentences(context), scored))["sentence"]

    return bind(tokens(question), pick)


def vote(hits: DataFrame, labels: DataFrame, question_id: str, corpus_id: str, label: str) -> DataFrame:
    """Majority label of each question's hits, the smallest of equals; a stand-in for a few-shot model.

    Returns ``question_id, label, votes``.
    """
    counted = (
        hits.join(labels.select(corpus_id, label), corpus_id)
        .groupBy(question_id, label)
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    return top_k(counted, [question_id], [F.col("votes").desc(), F.col(label).asc()], 1, rank="__rk").drop("__rk")


def abstain(
    hits: DataFrame, question_id: str, score: str, threshold: float, answer: Column, fallback: str,
    questions: DataFrame | None = None,
) -> DataFrame:
    """Each question's best score, and ``answer`` (an aggregate) only if that reaches ``threshold``.

    With ``questions`` (their ids) one without hits has its row too: no score and the fallback.
    """
    best = F.max(score)
    gated = hits.groupBy(question_id).agg(
        best.alias("best_score"), F.when(best >= threshold, answer).otherwise(F.lit(fallback)).alias("response")
    )
    if questions is None:
        return gated
    return questions.select(question_id).join(gated, question_id, "left").fillna({"response": fallback})


def lead_scorer(n: int) -> Scorer:
    """A deterministic scorer that returns a text's first ``n`` tokens; for tests and dry runs."""

    def load() -> Callable[[list[str]], list[str]]:
        token = re.compile(r"[^\W_]+")

        def score(texts: list[str]) -> list[str]:
            return [" ".join(m.group() for m in islice(token.finditer(t.lower()), n)) for t in texts]

        return score

    return Scorer(f"first {n} tokens", load)
