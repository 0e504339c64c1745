"""Landed pages to a chunk table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.functions.html import ARTICLE, Selector, article_html, article_native, needs_parser
from passagework.operators.chunking import chunk_html
from passagework.operators.rows import compute_once


def extract_articles(
    pages: DataFrame, keep: list[str], html: str = "html", selector: Selector = ARTICLE, native: bool = False
) -> DataFrame:
    """The article of each page as column ``article``; pages without one are left out.

    ``native`` promises that containers do not nest and keeps every page in the JVM.
    """
    if native:
        article = article_native(F.col(html), selector)
    else:
        pages = compute_once(pages, [*keep, html], __parser=needs_parser(F.col(html), selector))
        article = article_html(F.col(html), F.col("__parser"), selector)
    return compute_once(pages, keep, article=article).where(F.col("article").isNotNull())


def page_chunks(
    pages: DataFrame,
    keep: list[str],
    html: str = "html",
    selector: Selector = ARTICLE,
    native: bool = False,
    mark: str = "h2",
    titled: bool = True,
    min_tokens: int = 20,
    max_tokens: int = 400,
    overlap: int | None = 50,
    tokenizer: Callable[[], Callable[[str], int]] | None = None,
) -> DataFrame:
    """Pages to chunk rows: ``keep`` columns, ``chunk_pos, content, n_tokens``. ``tokenizer`` as in ``chunk_html``."""
    articles = extract_articles(pages, keep, html, selector, native)
    return chunk_html(articles, "article", keep, mark, titled, min_tokens, max_tokens, overlap, tokenizer)
