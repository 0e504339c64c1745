"""The recursive splitter as a table function for SQL: ``SELECT d.id, c.* FROM d, LATERAL split_text(d.text, 400, 50) c``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from passagework.functions.splitting import split_spans


@F.udtf(returnType="chunk_pos int, content string, n_tokens int")
class SplitText:
    """Rows of one text: position, content and number of tokens of each chunk. A null text has none."""

    def eval(self, text: str, max_tokens: int, overlap: int) -> Iterator[tuple[int, str, int]]:
        if text is not None:
            for pos, (content, n) in enumerate(split_spans(text, max_tokens, overlap)):
                yield pos, content, n


def register(spark: SparkSession, name: str = "split_text") -> None:
    """Make the function known to the session's SQL."""
    spark.udtf.register(name, SplitText)
