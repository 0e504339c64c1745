"""Token counts from a digest cache.

A text is known by the SHA-256 of its normalised content, a tokenizer by that of its library's name and version and its
file. The cache is a folder of ``tokenizer, content, n_tokens`` rows that grows by appending. Counting joins the digests of the
given texts to the stored ones, encodes only the different texts that are missing, appends their counts, and joins
the counts back to the rows. Normalising means: null is empty, anything else is its UTF-8. Nothing more is safe, as a tokenizer may
tell any two texts apart.

Texts move only if they are missing: copies are joined before the shuffle, and where few are missing (``FEW``, counted) the digests go to
the texts. A content that many rows hold has its count sent to them; the number of such contents is bounded by that of the rows over ``HOT``,
and it is sent only while within ``FEW``; otherwise all counts meet by shuffle.

Byte-level tokenizers cut texts before any single space between two visible characters (``separable``), so the
counts of the pieces add up, and a task encodes every different piece once; it forgets them beyond ``PIECES``. Other
tokenizers encode whole texts, in small groups. The tokenizer's file reaches the tasks as a broadcast of at most ``FILE_BYTES``.

Nulls and odd input: a null or empty text has no bytes and no tokens; repeated rows, shared and null ids are answered row by
row; a very long text is encoded in pieces where that is exact. An empty table gives an empty result and leaves the cache as it was. Other
columns are ignored. A run that fails has appended nothing or whole counts; two runs at a time may append a count twice, which is read once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from importlib.metadata import version
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm.text import whole
from passagework.session import stage

LIMIT = 512
FEW = 1_000_000
HOT = 10_000
PIECES = 300_000
GROUP_CHARS = 500_000  # characters encoded at once
FILE_BYTES = 64_000_000
# Visible characters of ASCII, Latin, Greek and Cyrillic; a single space between two of them opens a new piece.
_CUT = re.compile("(?<=[!-~À-ԯ]) (?=[!-~À-ԯ])")


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer's file and the library that reads it."""

    library: str
    file: bytes

    @staticmethod
    def of(path: str) -> Tokenizer:
        """``.json`` is read by ``tokenizers``, ``.model`` by ``sentencepiece``."""
        library = {".json": "tokenizers", ".model": "sentencepiece"}.get(Path(path).suffix)
        if library is None:
            raise ValueError(f"no library for {path}")
        file = Path(path).read_bytes()
        if len(file) > FILE_BYTES:
            raise ValueError(f"{path} has more than {FILE_BYTES} bytes")
        return Tokenizer(library, file)

    def digest(self) -> str:
        return hashlib.sha256(f"{self.library} {version(self.library)}\n".encode() + self.file).hexdigest()

    def load(self) -> Callable[[list[str]], list[int]]:
        """``texts -> numbers of tokens``, without begin, end or added tokens, truncation or padding."""
        if self.library == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.file)
            return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        model = tokenizers.Tokenizer.from_buffer(self.file)
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]

    def separable(self) -> bool:
        """Whether texts may be cut before a single space between visible characters: the byte-level pattern never
        joins across it, nothing is normalised, and no added token holds or strips a space."""
        if self.library != "tokenizers":
            return False
        made = json.loads(self.file)
        cut = made.get("pre_tokenizer") or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        added = made.get("added_tokens") or []
        kept = not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        return bool(plain and kept and not made.get("normalizer"))


def counter(tokenizer: Tokenizer) -> Callable[[list[str]], list[int]]:
    """``texts -> numbers of tokens`` with a memory of pieces where they add up."""
    encode = tokenizer.load()
    if not tokenizer.separable():
        return lambda texts: [n for group in groups(texts) for n in encode(group)]
    known: dict[str, int] = {}  # a piece without the space it opens with; the first piece of a text stands under "\0" + piece

    def count(texts: list[str]) -> list[int]:
        out = []
        for group in groups(texts):
            parts = [_CUT.split(t) for t in group]
            for p in parts:
                p[0] = "\0" + p[0]
            if len(known) > PIECES:
                known.clear()
            new = list(set().union(*parts) - known.keys())
            for some in groups(new):
                known.update(zip(some, encode([x[1:] if x[:1] == "\0" else " " + x for x in some])))
            out += [sum(map(known.__getitem__, p)) for p in parts]
        return out

    return count


def groups(texts: list[str]) -> Iterator[list[str]]:
    """Runs of the texts of about ``GROUP_CHARS``; a longer text stands alone."""
    own: list[str] = []
    size = 0
    for t in texts:
        if own and size + len(t) > GROUP_CHARS:
            yield own
            own, size = [], 0
        own.append(t)
        size += len(t) + 1
    if own:
        yield own


def stored(docs: DataFrame, cache: str, digest: str) -> DataFrame | None:
    """The cache's ``content, n_tokens`` for a tokenizer; None without a cache."""
    try:
        kept = docs.sparkSession.read.schema("content binary, n_tokens bigint").parquet(f"{cache}/tokenizer={digest}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return kept.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def encode(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``content, n_tokens`` of ``content, text``."""
    held = texts.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter(held.value)
            n = count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["content", "n_tokens"])

    return texts.mapInArrow(run, "content binary, n_tokens bigint")


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, cache: str, row_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``row_id, n_bytes, n_tokens, over_limit`` of every row; counts that ``cache`` lacks are appended to it."""
    digest = tokenizer.digest()
    texts = docs.select(row_id, whole(F.col(text)).alias("text"))
    texts = texts.withColumn("content", F.unhex(F.sha2(F.col("text"), 256)))
    seen = stage(texts.groupBy("content").agg(F.count(F.lit(1)).alias("copies")), "contents")
    known = stored(docs, cache, digest)
    missing = seen.select("content") if known is None else seen.select("content").join(known, "content", "left_anti")
    missing = missing if known is None else stage(missing, "missing")
    n = missing.count()
    if n:
        wanted = texts.select("content", "text")
        if known is not None and n <= FEW:
            wanted = wanted.join(F.broadcast(missing), "content", "left_semi")
        different = wanted.groupBy("content").agg(F.first("text").alias("text"))
        if known is not None and n > FEW:
            different = different.join(missing, "content", "left_semi")
        encode(different, tokenizer).write.mode("append").parquet(f"{cache}/tokenizer={digest}")
    known = stored(docs, cache, digest)
    ids = texts.select(row_id, F.octet_length("text").cast("bigint").alias("n_bytes"), "content")
    if known is None:  # no rows
        counted = ids.withColumn("n_tokens", F.lit(None).cast("bigint"))
    else:
        counted = _with_counts(ids, seen.join(known, "content"))
    return counted.select(row_id, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _with_counts(ids: DataFrame, counts: DataFrame) -> DataFrame:
    """``ids`` with ``n_tokens`` of their content. Contents of many rows are sent to them, so those rows do not meet in one task."""
    counts = stage(counts, "counts")
    hot = counts.where(F.col("copies") > HOT)
    many = hot.count()
    if not 0 < many <= FEW:
        return ids.join(counts.drop("copies"), "content")
    met = ids.join(F.broadcast(hot.select("content", F.col("n_tokens").alias("sent"))), "content", "left")
    # rows that are answered already go anywhere
    anywhere = F.sha2(F.concat(F.lit("answered "), F.monotonically_increasing_id().cast("string")), 0).cast("binary")
    met = met.withColumn("content", F.when(F.col("sent").isNotNull(), anywhere).otherwise(F.col("content")))
    met = met.join(counts.drop("copies"), "content", "left")
    return met.withColumn("n_tokens", F.coalesce("sent", "n_tokens"))
