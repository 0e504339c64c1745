"""Line dedup with two Bloom filters: hashes seen once and hashes seen twice.

Each task turns its lines' hashes into the bit positions of a once-seen and a twice-seen filter. Positions are merged
segment by segment: a bit seen by two tasks is a twice-seen bit. Only the twice-seen filter goes to the workers; a
line whose bits are all in it may repeat, and only such lines are shuffled, as a 128-bit digest, for the exact count of
documents and the choice of the occurrence that stays. The filters never miss a repeat, whatever their load, so their
bounded size (``MAX_BITS``, 128 MB) costs only extra suspects on very large inputs.

A key is a line stripped of blanks at both ends, A-Z in lower case. Keys of ``min_chars`` code points in at least
``min_docs`` documents lose all their lines except in the largest ``doc_id`` that holds them; the rest stays in place.
Nulls and odd input: a null text is one empty line. Rows with equal ids are one document when documents are counted
and keep the same lines; a null id is a document of its own that is never the largest. Columns other than
``doc_id`` and ``text`` are carried along. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.text import BLANKS, join_same, lines, lower_ascii, whole

MIN_CHARS = 40
MIN_DOCS = 5
SEGMENT = 16  # a segment holds 2**16 bits, so a position in it is two bytes
MAX_BITS = 30


def line_key(line: Column) -> Column:
    return F.btrim(lower_ascii(line), F.lit(BLANKS))


def _keys(text: Column, min_chars: int) -> Column:
    return F.filter(F.transform(lines(text), line_key), lambda k: F.char_length(k) >= min_chars)


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def filter_bits(docs: DataFrame, min_chars: int) -> int:
    """Enough for four bits a line that could be long enough, up to ``MAX_BITS``."""
    most = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    return min(MAX_BITS, max(SEGMENT, int(4 * most / (min_chars + 1)).bit_length()))


def twice_seen(hashes: DataFrame, bits: int) -> np.ndarray:
    """The merged twice-seen filter over a column ``hashes`` of hash arrays, as packed bits of bounded size."""

    def positions(values: np.ndarray) -> np.ndarray:
        return np.unique(np.concatenate(_probes(values, bits)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for b in batches]
        found = np.concatenate([*parts, np.empty(0, np.int64)]).view(np.uint64)
        distinct, counts = np.unique(found, return_counts=True)
        sides = [positions(distinct), positions(distinct[counts > 1])]
        rows: dict[int, list[bytes]] = {}
        for side, at in enumerate(sides):
            segment = (at >> np.uint64(SEGMENT)).astype(np.int64)
            ids, starts = np.unique(segment, return_index=True)
            for s, x in zip(ids.tolist(), np.split((at & np.uint64((1 << SEGMENT) - 1)).astype(np.uint16), starts[1:])):
                rows.setdefault(s, [b"", b""])[side] = x.tobytes()
        yield pa.RecordBatch.from_pydict(
            {
                "segment": pa.array(list(rows), pa.int64()),
                "once": pa.array([r[0] for r in rows.values()], pa.binary()),
                "twice": pa.array([r[1] for r in rows.values()], pa.binary()),
            }
        )

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        once, twice = (np.frombuffer(b"".join(group[c]), np.uint16) for c in ("once", "twice"))
        bit = np.bincount(once, minlength=1 << SEGMENT) > 1
        bit[twice] = True
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(bit).tobytes()]})

    merged = (
        hashes.mapInArrow(build, "segment bigint, once binary, twice binary")
        .groupBy("segment")
        .applyInPandas(merge, "segment bigint, bits binary")
    )
    size = 1 << (SEGMENT - 3)
    out = np.zeros(1 << (bits - 3), np.uint8)
    for segment, packed in merged.toLocalIterator():
        out[segment * size : (segment + 1) * size] = np.frombuffer(packed, np.uint8)
    return out


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, digest`` of the lines that a document loses."""
    bits = filter_bits(docs, min_chars)
    keys = docs.select("doc_id", _keys(F.col("text"), min_chars).alias("keys"))
    hashes = keys.select(F.transform("keys", lambda k: F.xxhash64(k)).alias("hashes"))
    held = docs.sparkSession.sparkContext.broadcast(twice_seen(hashes, bits))

    @F.pandas_udf(T.BooleanType())
    def suspected(h: pd.Series) -> pd.Series:
        seen, at = held.value, _probes(h.to_numpy(np.int64).view(np.uint64), bits)
        hit = [(seen[p >> np.uint64(3)] >> (7 - (p & np.uint64(7))).astype(np.uint8)) & 1 for p in at]
        return pd.Series((hit[0] & hit[1]).astype(bool))

    each = keys.select("doc_id", F.explode("keys").alias("key"))
    each = each.select("doc_id", F.xxhash64("key").alias("h"), F.md5("key").alias("digest"))
    suspects = each.where(suspected("h")).select("doc_id", "digest").distinct()
    known = suspects.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    known = known.where(F.col("n") >= min_docs).select("digest", "keeper")
    lost = suspects.join(known, "digest").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.select("doc_id", "digest")


_CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("dropped", T.LongType())])


@F.pandas_udf(_CUT)
def _without(text: pd.Series, digests: pd.Series) -> pd.DataFrame:
    def one(t: str | None, gone: np.ndarray | None) -> tuple[str | None, int]:
        if t is None or gone is None:
            return None, 0
        gone = set(gone)
        each = t.split("\n")
        kept = [x for x in each if hashlib.md5(x.strip(BLANKS).encode().lower()).hexdigest() not in gone]
        return "\n".join(kept), len(each) - len(kept)

    return pd.DataFrame([one(*x) for x in zip(text, digests)], columns=["text", "dropped"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and ``n_lines`` and ``n_dropped``."""
    lost = repeated_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    lost = lost.groupBy("doc_id").agg(F.collect_set("digest").alias("__gone"))
    joined = join_same(docs, lost, ["doc_id"], "left")
    cut = _without(F.when(F.col("__gone").isNotNull(), whole(F.col("text"))), F.col("__gone"))
    joined = joined.withColumn("__cut", cut)
    text = F.when(F.col("__gone").isNotNull(), F.col("__cut.text")).otherwise(whole(F.col("text")))
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return joined.select(
        *carried,
        text.alias("text"),
        F.size(lines(F.col("text"))).cast("bigint").alias("n_lines"),
        F.coalesce(F.col("__cut.dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
