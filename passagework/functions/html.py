"""Article extraction, clean-up and header sections of HTML, as column expressions.

Regular expressions are exact only while the container cannot nest. ``article_html`` therefore tests
each page natively and hands just the unsafe pages to a parser; the others never leave the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from passagework.functions.container import outer_container
from passagework.functions.text import bind, strip

# Fixed value: comments, scripts and styles, whose content is not markup of the page.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>"
# Fixed value: tags that end a line of text.
BLOCK_TAG = (
    r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|section|article|blockquote|pre)\b[^>]*>"
)
ANY_TAG = r"</?[A-Za-z!][^>]*>"


@dataclass(frozen=True)
class Selector:
    """The first ``tag`` element, if given with attribute ``attr`` equal to ``value``."""

    tag: str
    attr: str | None = None
    value: str | None = None

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9]*", self.tag):
            raise ValueError(f"not a tag name: {self.tag!r}")
        if (self.attr is None) != (self.value is None):
            raise ValueError("attr and value belong together")

    def open_pattern(self) -> str:
        if self.attr is None:
            return rf"<{self.tag}\b[^>]*>"
        attr = re.escape(self.attr)
        value = f"(?-i:{re.escape(self.value)})"  # names are case-blind in HTML, values are not
        return rf"""<{self.tag}\b[^>]*\s{attr}\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s>]))[^>]*>"""


ARTICLE = Selector("article")
ARTICLE_BODY = Selector("div", "itemprop", "articleBody")


def article_native(html: Column, selector: Selector = ARTICLE) -> Column:
    """Outer HTML by regular expression; null where there is none. Exact if containers do not nest."""
    pattern = rf"(?is){selector.open_pattern()}.*?</{selector.tag}\s*>"
    return bind(strip(F.regexp_extract(html, pattern, 0)), lambda found: F.when(found != "", found))


def needs_parser(html: Column, selector: Selector = ARTICLE) -> Column:
    """Whether a regular expression might find another element than a parser would.

    It cannot if the page has no such tag, or exactly one open and one close tag of that name, neither
    in a comment nor a script, and the open tag plainly carries the attribute asked for.
    """
    marks = F.lit(rf"(?i)</?{selector.tag}\b")
    pair = rf"(?is)^.*?<{selector.tag}\b.*?</{selector.tag}\s*>"

    def unsafe(total: Column) -> Column:
        bare = F.regexp_replace(html, HIDDEN, " ")
        hidden = bind(bare, lambda b: (F.regexp_count(b, marks) != 2) | ~b.rlike(pair))
        if selector.attr is not None:
            hidden = hidden | ~html.rlike(f"(?i){selector.open_pattern()}")
        return F.when(total == 0, F.lit(False)).when(total == 2, hidden).otherwise(F.lit(True))

    return bind(F.regexp_count(html, marks), unsafe)


def article_html(html: Column, parser: Column, selector: Selector = ARTICLE) -> Column:
    """Outer HTML of the first match; null if there is none. Exact for nested containers too.

    ``parser`` is ``needs_parser`` of the page. The parser's input is null for every page that does not
    need it, so only pages with nested, repeated or hidden containers are sent to Python.
    """
    tag, attr, value = selector.tag.lower(), selector.attr, selector.value

    @F.arrow_udf("string")
    def parse(pages: pa.Array) -> pa.Array:
        found = (outer_container(p, tag, attr, value) if p else None for p in pages.to_pylist())
        return pa.array(found, pa.string())

    return F.when(parser, parse(F.when(parser, html))).otherwise(article_native(html, selector))


# Numbers 128 to 159 mean Windows-1252 characters; the five that it leaves out stay as they are.
_WINDOWS = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]
# Names that also count without their semicolon; where several fit, the longest does.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _code_point(number: Column) -> Column:
    """The character of a code point; the replacement character for an invalid one."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    utf32 = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    windows = F.substr(F.lit("".join(_WINDOWS)), number - F.lit(127), F.lit(1))
    return F.when(number.between(128, 159), windows).when(valid, utf32).otherwise(F.lit("�"))


def decode_entities(text: Column) -> Column:
    """Character references to characters, in one pass: ``&amp;lt;`` becomes ``&lt;``, not ``<``.

    All names of HTML 5, the old ones among them and numbers also without a semicolon, as a browser reads text.
    """
    # One constant text folds to one map; thousands of literals would slow down every planning step.
    named = F.str_to_map(F.lit("\x01".join(f"{n}\x02{c}" for n, c in html5.items())), F.lit("\x01"), F.lit("\x02"))
    reference = r"^(#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)"
    bare = f"^({'|'.join(_BARE)})"
    # the map is searched from its start, so the references met most are tested first
    usual = [(f"{n};", html5[f"{n};"]) for n in ("amp", "lt", "gt", "quot", "nbsp")]

    def significant(name: Column, start: int) -> Column:
        """The digits without leading zeros; more than seven are no character."""
        digits = F.ltrim(F.rtrim(F.substr(name, F.lit(start)), F.lit(";")), F.lit("0"))
        return F.when(F.length(digits) > 7, F.lit("0")).otherwise(F.concat(F.lit("0"), digits))

    def piece(part: Column) -> Column:
        def with_rest(char: Column, length: Column) -> Column:
            return F.concat(char, F.substr(part, length + F.lit(1)))

        def by_name(name: Column) -> Column:
            known = F.try_element_at(named, name)
            for n, c in usual:
                known = F.when(name == n, F.lit(c)).otherwise(known)
            prefix = bind(F.regexp_extract(part, bare, 1), lambda b: F.when(b != "", with_rest(F.try_element_at(named, b), F.length(b))))
            return F.coalesce(with_rest(known, F.length(name)), prefix)

        def replaced(name: Column) -> Column:
            found = (
                F.when(name == "", F.lit(None).cast("string"))
                .when(F.lower(name).startswith("#x"), with_rest(_code_point(F.conv(significant(name, 3), 16, 10).cast("int")), F.length(name)))
                .when(name.startswith("#"), with_rest(_code_point(significant(name, 2).try_cast("int")), F.length(name)))
                .otherwise(by_name(name))
            )
            return F.coalesce(found, F.concat(F.lit("&"), part))

        return bind(F.regexp_extract(part, reference, 1), replaced)

    def join(parts: Column) -> Column:
        tail = F.transform(F.slice(parts, F.lit(2), F.array_size(parts)), piece)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))

    return bind(text, lambda t: F.when(t.contains("&"), bind(F.split(t, "&"), join)).otherwise(t))


def clean_text(html: Column) -> Column:
    """Visible text: hidden parts and tags gone, block tags as line breaks, references decoded."""
    return _visible_text(F.regexp_replace(html, HIDDEN, " "))


def _visible_text(html: Column) -> Column:
    """``clean_text`` of markup whose hidden parts are gone already."""
    out = F.regexp_replace(html, BLOCK_TAG, "\n")
    out = F.regexp_replace(out, ANY_TAG, "")
    out = decode_entities(out)
    out = F.regexp_replace(out, "[ \\t\\r\\f ]+", " ")
    out = F.regexp_replace(out, " ?\\n[ \\n]*", "\n")
    return strip(out)


def sections(article: Column, tag: str = "h2", titled: bool = True) -> Column:
    """Split at ``<tag>`` into ``array<struct<header, content>>`` of clean text.

    Text before the first mark has the header ``""``. With ``titled`` the text up to the closing
    ``</tag>`` is the section's header; without, the mark only separates and headers are empty.
    Sections without any text are left out.
    """
    Selector(tag)
    mark = rf"(?i)<{tag}\b[^>]*>"
    close = rf"(?is)^(.*?)</{tag}\s*>"
    visible = F.regexp_replace(article, HIDDEN, " ")

    def lead(part: Column) -> Column:
        return F.struct(F.lit("").alias("header"), _visible_text(part).alias("content"))

    def marked(part: Column) -> Column:
        if not titled:
            return lead(part)
        head, body = F.regexp_extract(part, close, 1), F.regexp_replace(part, close, "")
        return F.struct(_visible_text(head).alias("header"), _visible_text(body).alias("content"))

    def build(parts: Column) -> Column:
        first = F.transform(F.slice(parts, F.lit(1), F.lit(1)), lead)
        rest = F.transform(F.slice(parts, F.lit(2), F.array_size(parts)), marked)
        return F.concat(first, rest)

    built = bind(F.split(visible, mark), build)
    return F.filter(built, lambda s: (s["header"] != "") | (s["content"] != ""))


def section_text(header: Column, content: Column) -> Column:
    """Header, line break, content; a missing header counts as empty."""
    return F.concat(F.coalesce(header, F.lit("")), F.lit("\n"), content)
