"""Column expressions that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The runs of non-blank characters, in order."""
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def lines(text: Column) -> Column:
    """The text split at line feeds; a null or empty text is one empty line."""
    return F.split(whole(text), "\n", -1)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def chance(*of: Column) -> Column:
    """A number in [0, 1) that depends on the given values alone, so reruns and retried tasks agree."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


def join_same(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """An equi-join in which null keys meet; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    met = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    condition = met[0]
    for m in met[1:]:
        condition &= m
    return left.join(renamed, condition, how).drop(*(f"__{c}" for c in on))
