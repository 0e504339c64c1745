"""Retrieved rows to prompt context, example blocks and answer reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.text import escape_markup

# Fixed value: what stands between two documents of a stuffed context.
JOINER = "\n\n"


def as_documents(df: DataFrame, content_col: str) -> DataFrame:
    """Rows as documents: ``page_content`` and a ``metadata`` struct of all other columns."""
    others = [c for c in df.columns if c != content_col]
    metadata = F.struct(*others) if others else F.struct(F.lit(None).cast("string").alias("none"))
    return df.select(F.col(content_col).alias("page_content"), metadata.alias("metadata"))


def attach(hits: DataFrame, chunks: DataFrame, chunk_id: str, columns: list[str]) -> DataFrame:
    """Add columns of the hit chunks. Only chunks that were hit are carried into the join."""
    return hits.join(chunks.select(chunk_id, *columns), chunk_id)


def in_rank_order(rank: str, *columns: str) -> Column:
    """Aggregate: the group's rows as an array of structs ordered by rank (k rows per group)."""
    return F.array_sort(F.collect_list(F.struct(rank, *columns)))


def stuff(
    hits: DataFrame, question_id: str, content: str = "content", rank: str = "rk", questions: DataFrame | None = None
) -> DataFrame:
    """One context per question: its hits' contents in rank order, a blank line between two.

    With ``questions`` (their ids) each of them has its row, an empty context if it has no hit.
    """
    ordered = in_rank_order(rank, content)
    context = F.array_join(F.transform(ordered, lambda d: d[content]), JOINER)
    stuffed = hits.groupBy(question_id).agg(context.alias("context"), F.count(F.lit(1)).alias("n_docs"))
    if questions is None:
        return stuffed
    return questions.select(question_id).join(stuffed, question_id, "left").fillna({"context": "", "n_docs": 0})


def example_block(examples: DataFrame, order: list[str], n: int, text: str, label: str) -> Column:
    """The first ``n`` labelled rows by ``order`` as one few-shot block, as a scalar subquery.

    Only those ``n`` rows are gathered; the block reaches every prompt without a join.
    """
    first = examples.orderBy(*order).limit(n)
    keys = (F.col(c).alias(f"k{i}") for i, c in enumerate(order))
    entry = F.struct(*keys, F.col(text).alias("t"), F.col(label).alias("l"))
    lines = F.transform(
        F.array_sort(F.collect_list(entry)),
        lambda e: F.concat(F.lit("- "), e["l"].cast("string"), F.lit(": "), e["t"]),
    )
    return first.agg(F.array_join(lines, "\n").alias("examples")).scalar()


def report(question: Column, answer: Column, references: Column) -> Column:
    """Question, answer and references as an HTML fragment; every inserted value is escaped.

    ``references`` is an array of structs with ``content`` and ``source``, in the order to show; each
    becomes a list item that ends in a link to its source.
    """

    def cited(reference: Column) -> Column:
        source = escape_markup(reference["source"])
        return F.concat(
            F.lit("<li>"), escape_markup(reference["content"]), F.lit(' <a href="'), source, F.lit('">'), source,
            F.lit("</a></li>"),
        )

    return F.concat(
        F.lit("<section><h3>Question</h3><p>"), escape_markup(question),
        F.lit("</p><h3>Answer</h3><p>"), escape_markup(answer),
        F.lit("</p><h3>References</h3><ol>"), F.array_join(F.transform(references, cited), ""),
        F.lit("</ol></section>"),
    )
