"""Retrieval question answering over a table of questions, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.functions.templates import render
from passagework.operators.context import JOINER, in_rank_order
from passagework.operators.retrieval import Index, caller_columns, retrieve_chunks
from passagework.operators.scoring import Scorer, batch_score, best_sentence


def answer(
    questions: DataFrame,
    index: Index,
    source: str,
    template: str,
    k: int = 2,
    scorer: Scorer | None = None,
    question_id: str = "qid",
    text: str = "question",
    min_score: float | None = None,
    fallback: str = "I do not know.",
) -> DataFrame:
    """``question_id, question, prompt, output_text, input_documents`` of every question.

    ``scorer`` maps prompts to answers. Without one the answer is the context's best matching
    sentence, an offline stand-in. A hit needs a score above 0, or of ``min_score`` at least if that is given. A question without one
    has the answer ``fallback``, an empty context and no documents; so has one whose context has no sentence. A null question has
    no hit and stands empty in its prompt. Repeated question ids are an error. ``input_documents`` are structs ``rk, content, source, metadata``, best first; ``metadata`` holds
    all other columns of the chunks the index was built from.
    """
    others = [c for c in caller_columns(index) if c != "content"]
    hits = retrieve_chunks(questions, index, ["content", *others], k, question_id, text, above=None if min_score is not None else 0.0)
    if min_score is not None:
        hits = hits.where(F.col("score") >= min_score)
    hits = hits.select(
        question_id, "rk", "content", F.col(source).cast("string").alias("source"), F.struct(*others).alias("metadata")
    )
    grouped = hits.groupBy(question_id).agg(in_rank_order("rk", "content", "source", "metadata").alias("input_documents"))
    none = F.array().cast(dict(grouped.dtypes)["input_documents"])
    asked = questions.select(question_id, F.col(text).alias("question"))
    grouped = asked.join(grouped, question_id, "left").withColumn("input_documents", F.coalesce("input_documents", none))
    context = F.array_join(F.transform("input_documents", lambda d: d["content"]), JOINER)
    stuffed = grouped.withColumn("__context", context)
    prompted = stuffed.withColumn(
        "prompt", render(template, {"context": F.col("__context"), "question": F.coalesce("question", F.lit(""))})
    )
    if scorer is None:
        answered = prompted.withColumn("output_text", best_sentence(F.col("__context"), F.col("question")))
    else:
        answered = batch_score(prompted, scorer, ["prompt"], "output_text")
    found = F.when(F.array_size("input_documents") > 0, F.col("output_text"))
    answered = answered.withColumn("output_text", F.coalesce(found, F.lit(fallback)))
    return answered.select(question_id, "question", "prompt", "output_text", "input_documents")
