"""Sections to chunks: greedy merge, recursive split, minimum length, one row per chunk.

All steps work inside one row, so chunking needs no shuffle. Only texts with an unbroken word above the chunk size
leave the JVM, and only when the recursive splitter is asked for.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions import html as H
from passagework.functions.spans import has_long_word, split_text
from passagework.functions.splitting import SEPARATORS, split_spans
from passagework.functions.text import bind, strip, token_count
from passagework.operators.rows import compute_once, explode_present

CHUNKS_TYPE = "array<struct<content:string,n_tokens:int>>"
_SPANS = "array<struct<first:int,size:int,n:int>>"
_ARROW_CHUNKS = pa.list_(pa.struct([("content", pa.string()), ("n_tokens", pa.int32())]))


def merge_sections(texts: Column, max_tokens: int = 400) -> Column:
    """Greedy merge of ``array<string>`` in order, into ``array<struct<content, n_tokens>>``.

    A section joins the open chunk while both together hold at most half of ``max_tokens``; otherwise
    the chunk is closed. A longer section stands alone. Blank chunks are left out. Each section is
    counted once: counts add up because a line break always parts two tokens.
    """
    limit = F.lit(max_tokens // 2)

    def spans(counted: Column) -> Column:
        """Chunks as runs of sections. The fold moves numbers only; texts are joined once, below."""
        start = F.struct(
            F.array().cast(_SPANS).alias("done"), F.lit(0).alias("first"), F.lit(0).alias("size"), F.lit(0).alias("n")
        )

        def closed(acc: Column) -> Column:
            return F.when(acc["size"] == 0, acc["done"]).otherwise(
                F.concat(acc["done"], F.array(F.struct(acc["first"], acc["size"], acc["n"])))
            )

        def step(acc: Column, section: Column) -> Column:
            fits = acc["n"] + section["n"] <= limit
            return F.struct(
                F.when(fits, acc["done"]).otherwise(closed(acc)).alias("done"),
                F.when(fits, acc["first"]).otherwise(acc["first"] + acc["size"]).alias("first"),
                F.when(fits, acc["size"] + F.lit(1)).otherwise(F.lit(1)).alias("size"),
                F.when(fits, acc["n"] + section["n"]).otherwise(section["n"]).alias("n"),
            )

        return F.aggregate(counted, start, step, closed)

    def chunks(counted: Column) -> Column:
        def joined(span: Column) -> Column:
            run = F.slice(counted, span["first"] + F.lit(1), span["size"])
            content = strip(F.array_join(F.transform(run, lambda s: s["text"]), "\n"))
            return F.struct(content.alias("content"), span["n"].alias("n_tokens"))

        return F.transform(spans(counted), joined)

    counted = F.transform(texts, lambda t: F.struct(t.alias("text"), token_count(t).alias("n")))
    counted = F.filter(counted, lambda s: s["text"].isNotNull())
    return F.filter(bind(counted, chunks), lambda c: c["content"] != "")


def whole_text(text: Column) -> Column:
    """A text as a single chunk, the splitter's input when there is nothing to merge; none for a blank one."""
    chunk = F.struct(strip(text).alias("content"), token_count(text).alias("n_tokens"))
    return F.filter(F.array(chunk).cast(CHUNKS_TYPE), lambda c: c["content"] != "")


def split_long(
    chunks: Column, max_tokens: int = 400, overlap: int = 50, separators: tuple[str, ...] = SEPARATORS
) -> Column:
    """Split the chunks of ``max_tokens`` or more into overlapping chunks of at most ``max_tokens``.

    The JVM splits whatever has blanks to split at (``functions.spans``). Only arrays with an overlong unbroken word, which is cut
    between characters, go to Python, where null stands for all others. Other separators than the default send every array there.
    """
    if not 0 <= overlap < max_tokens:
        raise ValueError("overlap must be at least 0 and below max_tokens")

    @F.arrow_udf(CHUNKS_TYPE)
    def split(arrays: pa.Array) -> pa.Array:
        out = []
        for items in arrays.to_pylist():
            if items is None:
                out.append(None)
                continue
            parts = (split_spans(i["content"], max_tokens, overlap, separators) for i in items)
            out.append([{"content": c, "n_tokens": n} for part in parts for c, n in part])
        return pa.array(out, _ARROW_CHUNKS)

    def for_python(chunk: Column) -> Column:
        # A text without any blank is cut between characters, whatever its token count.
        unbroken = ~chunk["content"].rlike("[ \\n]") & (F.length(chunk["content"]) > max_tokens)
        return unbroken | ((chunk["n_tokens"] >= max_tokens) & has_long_word(chunk["content"], max_tokens))

    if tuple(separators) != SEPARATORS:
        return split(chunks)

    def one(chunk: Column) -> Column:
        return F.when(chunk["n_tokens"] >= max_tokens, split_text(chunk["content"], max_tokens, overlap)).otherwise(F.array(chunk))

    left = F.coalesce(F.exists(chunks, for_python), F.lit(False))
    # Long texts are split in the JVM; arrays without any pass as they are.
    is_long = F.coalesce(F.exists(chunks, lambda c: c["n_tokens"] >= max_tokens), F.lit(False))
    native = F.when(is_long, F.flatten(F.transform(chunks, one))).otherwise(chunks)
    return F.when(left, split(F.when(left, chunks))).otherwise(native)


def split_with_tokenizer(
    sections: Column,
    load: Callable[[], Callable[[str], int]],
    max_tokens: int = 400,
    overlap: int = 50,
    min_tokens: int = 20,
    separators: tuple[str, ...] = SEPARATORS,
) -> Column:
    """Merge, split and filter ``array<string>`` with a caller's token counter instead of the default.

    ``load`` runs once per Python worker and returns ``text -> number of tokens``. Subword counts do
    not add up across joins, so merged text is counted again as a whole.
    """

    @F.arrow_udf(CHUNKS_TYPE)
    def chunk(batches: pa.Array) -> pa.Array:
        count = load()
        out = []
        for texts in batches.to_pylist():
            if texts is None:
                out.append(None)
                continue
            texts = [t for t in texts if t is not None]
            bounds = [0]
            while bounds[-1] < len(texts):
                start = bounds[-1]
                # how many sections from here fit together: counts grow with the end, so halving finds it
                fit = bisect_right(
                    range(start + 1, len(texts) + 1), max_tokens / 2, key=lambda end: count("\n".join(texts[start:end]))
                )
                bounds.append(start + max(1, fit))
            merged = ["\n".join(texts[a:z]) for a, z in pairwise(bounds)]
            parts = [
                c
                for m in merged
                for c, _ in split_spans(m.strip(), max_tokens, overlap, separators, count)
            ]
            counted = [{"content": c, "n_tokens": count(c)} for c in parts]
            out.append([c for c in counted if c["n_tokens"] > min_tokens])
        return pa.array(out, _ARROW_CHUNKS)

    return chunk(sections)


def longer_than(chunks: Column, min_tokens: int = 20) -> Column:
    """Keep chunks of strictly more than ``min_tokens`` tokens."""
    return F.filter(chunks, lambda c: c["n_tokens"] > min_tokens)


def explode_chunks(df: DataFrame, chunks: Column, keep: list[str]) -> DataFrame:
    """One row per chunk with its position; rows without chunks disappear."""
    return explode_present(df, keep, chunks, "chunk_pos", "__chunk").select(*keep, "chunk_pos", "__chunk.*")


def chunk_html(
    pages: DataFrame,
    html_col: str,
    keep: list[str],
    mark: str = "h2",
    titled: bool = True,
    min_tokens: int = 20,
    max_tokens: int = 400,
    overlap: int | None = 50,
    tokenizer: Callable[[], Callable[[str], int]] | None = None,
) -> DataFrame:
    """Article HTML to chunk rows: sections, merge, split, minimum length, explode.

    All counts are those of ``tokenizer`` if one is given: a function that loads, once per task, ``text -> number of tokens``.

    ``overlap=None`` leaves out the recursive splitter, so a single section may stay above ``max_tokens``; the plan then has no
    Python step at all.
    """
    texts = F.transform(
        H.sections(F.col(html_col), mark, titled), lambda s: H.section_text(s["header"], s["content"])
    )
    return _chunks(pages, keep, texts, min_tokens, max_tokens, overlap, tokenizer)


def chunk_text(
    df: DataFrame,
    text_col: str,
    keep: list[str],
    min_tokens: int = 20,
    max_tokens: int = 400,
    overlap: int | None = 50,
    tokenizer: Callable[[], Callable[[str], int]] | None = None,
) -> DataFrame:
    """Plain text to chunk rows, with lines as sections. ``overlap`` and ``tokenizer`` as in ``chunk_html``."""
    return _chunks(df, keep, F.split(F.col(text_col), "\n"), min_tokens, max_tokens, overlap, tokenizer)


def _chunks(
    df: DataFrame, keep: list[str], texts: Column, min_tokens: int, max_tokens: int, overlap: int | None,
    tokenizer: Callable[[], Callable[[str], int]] | None,
) -> DataFrame:
    if tokenizer is not None:
        df = compute_once(df, keep, __texts=texts)
        return explode_chunks(df, split_with_tokenizer(F.col("__texts"), tokenizer, max_tokens, overlap or 0, min_tokens), keep)
    chunks = merge_sections(texts, max_tokens)
    if overlap is not None:
        df = compute_once(df, keep, __chunks=chunks)
        chunks = split_long(F.col("__chunks"), max_tokens, overlap)
    return explode_chunks(df, longer_than(chunks, min_tokens), keep)
