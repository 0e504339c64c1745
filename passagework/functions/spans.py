"""The recursive splitter as column expressions: atoms of one text, and a fold that packs them.

A text is cut at the first separator it holds, each separator staying at the front of the piece it opens; a piece of ``size`` tokens
or more is cut on at the next finer separator. What is left are atoms in order, in runs: neighbours of the same cut without
a larger piece between them. One fold over the atoms packs each run into spans of at most ``size`` tokens, carrying over trailing
atoms of at most ``overlap``. Token counts of atoms add up, as every separator parts two tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from passagework.functions.text import bind, strip, token_count

# Separators from coarse to fine. Beyond the last one a word would be cut between characters.
SEPARATORS = ("\n\n", "\n", " ")
_SPANS = "array<struct<first:int,size:int>>"


def has_long_word(text: Column, size: int) -> Column:
    """Whether a run without a blank may hold ``size`` tokens, so that only a cut between characters helps."""
    return text.rlike(rf"[^ \n]{{{2 * size - 1},}}")


def pieces(text: Column, separator: str) -> Column:
    """The non-empty parts of a text, all but the first with the separator they open with."""
    parts = F.split(text, separator, -1)
    opened = F.transform(parts, lambda p, i: F.when(i > 0, F.concat(F.lit(separator), p)).otherwise(p))
    return F.filter(opened, lambda p: p != "")


def atoms(text: Column, size: int) -> Column:
    """``array<struct<text, n, opens>>`` of a text of at least ``size`` tokens; ``opens`` marks the first atom of a run."""

    def atom(piece: Column, opens: Column) -> Column:
        return F.array(F.struct(piece["text"].alias("text"), piece["n"].alias("n"), opens.alias("opens")))

    def cut(t: Column, separator: str, finer: Callable[[Column], Column] | None) -> Column:
        counted = F.transform(pieces(t, separator), lambda p: F.struct(p.alias("text"), token_count(p).alias("n")))

        def each(c: Column) -> Column:
            def one(piece: Column, i: Column) -> Column:
                opens = F.coalesce(F.get(c, i - 1)["n"] >= size, F.lit(True))
                own = atom(piece, opens)
                return own if finer is None else F.when(piece["n"] < size, own).otherwise(finer(piece["text"]))

            return F.flatten(F.transform(c, one))

        return bind(counted, each)

    def level(k: int) -> Callable[[Column], Column]:
        # a text without the separator is one piece, too large like itself, and so goes on to the next
        finer = level(k + 1) if k + 1 < len(SEPARATORS) else None
        return lambda t: cut(t, SEPARATORS[k], finer)

    return level(0)(text)


def packed(a: Column, size: int, overlap: int) -> Column:
    """``array<struct<first, size>>``: the atoms of each chunk. Two pointers move over the atoms; only numbers are kept."""

    def span(acc: Column) -> Column:
        return F.array(F.struct(acc["low"].alias("first"), (acc["high"] - acc["low"]).alias("size")))

    def shrunk(acc: Column, n: Column) -> Column:
        """The window without its first atoms, so that it is within the overlap and has room for ``n`` more."""
        room = F.least(F.lit(overlap), F.lit(size) - n)
        window = F.slice(a, acc["low"] + 1, acc["high"] - acc["low"])
        start = F.struct(acc["low"].alias("low"), acc["total"].alias("total"))
        return F.aggregate(
            window, start,
            lambda w, x: F.when(w["total"] > room, F.struct((w["low"] + 1).alias("low"), (w["total"] - x["n"]).alias("total"))).otherwise(w),
        )

    def step(acc: Column, x: Column) -> Column:
        filled = acc["high"] > acc["low"]
        over = filled & (acc["total"] + x["n"] > size)
        fresh = F.struct(acc["high"].alias("low"), F.lit(0).alias("total"))
        same = F.struct(acc["low"].alias("low"), acc["total"].alias("total"))
        window = F.when(x["opens"], fresh).when(over, shrunk(acc, x["n"])).otherwise(same)
        spans = F.when((x["opens"] & filled) | over, F.concat(acc["spans"], span(acc))).otherwise(acc["spans"])
        return bind(
            window,
            lambda w: F.struct(
                spans.alias("spans"), w["low"].alias("low"), (acc["high"] + 1).alias("high"), (w["total"] + x["n"]).alias("total")
            ),
        )

    zero = F.lit(0)
    start = F.struct(F.array().cast(_SPANS).alias("spans"), zero.alias("low"), zero.alias("high"), zero.alias("total"))
    return F.aggregate(a, start, step, lambda acc: F.when(acc["high"] > acc["low"], F.concat(acc["spans"], span(acc))).otherwise(acc["spans"]))


def split_text(text: Column, size: int, overlap: int) -> Column:
    """``array<struct<content, n_tokens>>`` of a text of at least ``size`` tokens without overlong words; blank chunks are left out."""

    def chunk(a: Column, s: Column) -> Column:
        def joined(own: Column) -> Column:
            content = strip(F.array_join(F.transform(own, lambda x: x["text"]), ""))
            n = F.aggregate(own, F.lit(0), lambda total, x: total + x["n"])
            return F.struct(content.alias("content"), n.alias("n_tokens"))

        return bind(F.slice(a, s["first"] + 1, s["size"]), joined)

    chunks = bind(atoms(text, size), lambda a: F.transform(packed(a, size, overlap), lambda s: chunk(a, s)))
    return F.filter(chunks, lambda c: c["content"] != "")
