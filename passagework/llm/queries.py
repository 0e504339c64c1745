"""The registered queries of the numbered operators, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.llm import (
    chat, decontam, gam, hard_negatives, line_dedup, mixing, ngram_join, ngram_lm, quality_rules, repeats, token_counts, toxicity, whitening,
)
from passagework.llm.text import word_count
from passagework.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query
def op1_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_lm.score_held_out(_table(spark, sf, "documents").select("doc_id", "text"))


@_query
def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix_sizes(sized).select("doc_id", "size", "source_size", "target", "taken")


@_query
def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return ngram_join.near_copies(docs, words=4, percent=85).select("doc_id", "n_shingles", "component_id")


@_query
def op5_chat(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.read_back(chat.render(chat.fold(chat.event_log(rows))))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@_query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf, "documents").select("doc_id", "text", "lang"), _table(spark, sf, "labels"))
    return judged.select("doc_id", *quality_rules.METRICS, "base_failed", "kept")


@_query
def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents").select("doc_id", "text"), _table(spark, sf, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels)).select("doc_id", "held_out", "score", "predicted")


@_query
def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return decontam.matches(docs, _table(spark, sf, "benchmark").select("item_id", "text")).select("doc_id", "item_id", "similarity", "start")


@_query
def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents").select("doc_id", "text"), _table(spark, sf, "labels")
    return gam.score(docs, gam.train(docs, labels)).select("doc_id", "held_out", "score", "predicted")


@_query
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = repeats.remove_repeats(_table(spark, sf, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """A deviation beyond a long is null."""
    whitened = whitening.whitened_vectors(_table(spark, sf, "embeddings").select("vec_id", "embedding"))
    return whitened.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@_query
def op12_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """With a cache of its own, so every run encodes all different texts."""
    import public_tokenizers

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    tokenizer = token_counts.Tokenizer.of(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.count_tokens(docs, tokenizer, scratch_path(spark, "token-cache"))


@_query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0, F.col("vec_id"), moved)


# The same line key as the operator's: stripped of blanks at both ends, A-Z in lower case.
ORACLE["op3_line_dedup"] = r"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM cut),
known AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT c.doc_id, c.pos, c.line, n.k IS NOT NULL AND n.keeper <> c.doc_id AS gone
  FROM keyed c LEFT JOIN known n ON c.k = n.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE["op5_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(10 + 8 + 4 + length(role) + length(text)
           + len(regexp_extract_all(role, '[<\[]\\*(?:/?s>|/?INST\])'))
           + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\])'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

ORACLE["op13_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.id <> r.id WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 10
"""
