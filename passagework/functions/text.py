"""Token and text expressions. All of them are built-in column expressions and stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of Unicode letters and digits.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
# Fixed value: a sentence is a run without . ! ? or line break, plus its closing marks.
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"
# Fixed value: characters removed at both ends of a text.
BLANKS = " \t\n\r\f\x0b"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Without this a long expression used twice (once for its size, once for its items) would be
    evaluated at every use, for instance once per window of a document.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def tokens(text: Column) -> Column:
    """Lower-cased tokens in order; null for null."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(text: Column) -> Column:
    """Number of tokens; null for null whatever the session's ANSI setting is."""
    return F.array_size(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0)))


def _token_parts(text: Column) -> Column:
    """The text up to its last token in parts, each a token with what stands before it."""
    return F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{N}]*[\p{L}\p{N}]+"), F.lit(0))


def truncate_tokens(text: Column, limit: int) -> Column:
    """The text as it stands up to the end of its token number ``limit``; all of it if it has no more tokens."""

    def cut(parts: Column) -> Column:
        return F.when(F.array_size(parts) <= limit, text).otherwise(F.array_join(F.slice(parts, 1, limit), ""))

    return bind(_token_parts(text), cut)


def token_windows(text: Column, size: int = 400, overlap: int = 50) -> Column:
    """Windows of ``size`` tokens; neighbours share ``overlap`` tokens. No tokens, no window.

    A window is the text as it stands from its first token to its last.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap

    def windows(parts: Column) -> Column:
        last = F.greatest(F.array_size(parts) - F.lit(overlap + 1), F.lit(0))
        starts = F.sequence(F.lit(0), last, F.lit(step))

        def window(s: Column) -> Column:
            return F.regexp_replace(F.array_join(F.slice(parts, s + F.lit(1), F.lit(size)), ""), r"^[^\p{L}\p{N}]+", "")

        return F.when(F.array_size(parts) > 0, F.transform(starts, window)).when(parts.isNotNull(), F.array().cast("array<string>"))

    return bind(_token_parts(text), windows)


def sentences(text: Column) -> Column:
    """Trimmed sentences that hold at least one token, in order."""
    parts = F.regexp_extract_all(text, F.lit(SENTENCE_PATTERN), F.lit(0))
    return F.filter(F.transform(parts, strip), lambda s: s.rlike(TOKEN_PATTERN))


def namespace_part(address: Column) -> Column:
    """The part of a user address before its first dot or at sign."""
    return F.get(F.split(address, "[.@]"), F.lit(0))


def escape_markup(text: Column) -> Column:
    """Escape the five characters that matter in HTML text and attribute values."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    # The HTML references of the remaining four characters.
    for char, ref in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(char), F.lit(ref))
    return out
