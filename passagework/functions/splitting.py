"""Per-text helper of the recursive splitter: token-bounded, overlapping spans of one text."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence

# Letters and digits of any script; the same runs as the JVM pattern of ``functions.text``.
_TOKEN = re.compile(r"[^\W_]+")
# Separators from coarse to fine; the empty one cuts between characters.
SEPARATORS = ("\n\n", "\n", " ", "")


class TokenIndex:
    """Token positions of one text, so that counting the tokens of a span is two binary searches."""

    def __init__(self, text: str):
        found = list(_TOKEN.finditer(text))
        self.starts = [m.start() for m in found]
        self.ends = [m.end() for m in found]

    def count(self, begin: int, end: int) -> int:
        return bisect_left(self.starts, end) - bisect_right(self.ends, begin)


def _pieces(text: str, begin: int, end: int, separator: str) -> list[tuple[int, int]]:
    """Spans between separators; each separator stays at the front of the span it opens."""
    if separator == "":
        return [(i, i + 1) for i in range(begin, end)]
    cuts = [begin]
    at = text.find(separator, begin, end)
    while at >= 0:
        if at > cuts[-1]:
            cuts.append(at)
        at = text.find(separator, at + len(separator), end)
    return list(zip(cuts, [*cuts[1:], end]))


def _pack(run: list[tuple[int, int, int]], size: int, overlap: int) -> list[tuple[int, int]]:
    """Join neighbouring pieces up to ``size``; carry over trailing pieces of at most ``overlap``."""
    spans, low, total = [], 0, 0
    for high, (_, _, weight) in enumerate(run):
        if total + weight > size and high > low:
            spans.append((run[low][0], run[high - 1][1]))
            while total > overlap or (total > 0 and total + weight > size):
                total -= run[low][2]
                low += 1
        total += weight
    if run:
        spans.append((run[low][0], run[-1][1]))
    return spans


def split_spans(
    text: str,
    size: int = 400,
    overlap: int = 50,
    separators: Sequence[str] = SEPARATORS,
    counter: Callable[[str], int] | None = None,
) -> list[tuple[str, int]]:
    """Chunks of one text with their token counts, in order. Empty or blank text gives none.

    ``counter`` replaces the default token counter; it is called once per piece.
    """
    if counter is None:
        count = TokenIndex(text).count
    else:
        count = lambda begin, end: counter(text[begin:end])

    def descend(begin: int, end: int, level: int) -> list[tuple[int, int]]:
        while separators[level] and text.find(separators[level], begin, end) < 0 and level + 1 < len(separators):
            level += 1
        spans: list[tuple[int, int]] = []
        run: list[tuple[int, int, int]] = []
        for a, b in _pieces(text, begin, end, separators[level]):
            weight = count(a, b)
            if weight < size:
                run.append((a, b, weight))
                continue
            spans += _pack(run, size, overlap)
            run = []
            spans += descend(a, b, level + 1) if level + 1 < len(separators) else [(a, b)]
        return spans + _pack(run, size, overlap)

    out = []
    for a, b in descend(0, len(text), 0) if text else []:
        chunk = text[a:b].strip()
        if chunk:
            out.append((chunk, count(a, b)))
    return out
