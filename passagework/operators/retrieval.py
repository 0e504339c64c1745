"""The index of a chunk table and the lookup of a whole table of questions in it.

An index is a folder. ``versions/<name>`` holds the written tables of one version: ``chunks`` (a row per chunk: its id, content,
source columns, the content's digest, and term counts or a model's vector) and, for the built-in vectors, ``idf`` (a row per
dimension). ``manifest`` has a row for each version; the newest one is the index. A version is complete before its row is
appended, so a build that stops half-way changes nothing for readers, and the switch is one small write.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.functions.text import bind
from passagework.operators.context import attach
from passagework.operators.embedding import DIM, TERMS_TYPE, Embedder, embed_with, idf_table, term_counts, weigh
from passagework.operators.nearest import nearest
from passagework.session import stage
from passagework.sources.shared import remove_folder

HASHED = "hashed-tf-idf"
# Versions kept: the newest, and the one that readers may still have open.
KEPT_VERSIONS = 2
# Hits whose ids may go to the scan of their content as a filter.
FETCHED_IDS = 10_000
# Columns of an index's chunks that are not the caller's.
OWN = ("digest", "terms", "embedding", "norm")


def chunk_key(source: str, position: str = "chunk_pos") -> Column:
    """Id of a chunk: its source's id and its position there."""
    return F.concat_ws("-", F.col(source).cast("string"), F.col(position).cast("string"))


@dataclass(frozen=True)
class Index:
    """An opened index. ``idf`` belongs to the built-in vectors, ``model`` to a caller's."""

    chunks: DataFrame
    name: str
    dim: int
    idf: DataFrame | None = None
    model: Embedder | None = None
    folder: str = ""
    chunk_id: str = "chunk_id"


def _versions(spark: SparkSession, path: str) -> list:
    """The manifest's rows, newest first: one for each build."""
    try:
        rows = spark.read.parquet(f"{path}/manifest").collect()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []
    return sorted(rows, key=lambda r: (r["version"], r["folder"]), reverse=True)


def build_index(
    spark: SparkSession,
    chunks: DataFrame,
    path: str,
    chunk_id: str = "chunk_id",
    content: str = "content",
    dim: int = DIM,
    model: Embedder | None = None,
) -> Index:
    """Write a version of the index of ``chunks`` to ``path`` and open it; earlier ones are replaced.

    Vectors are those of ``model``, or else hashed TF-IDF weights, whose term counts alone are stored: weights follow from them
    and ``idf`` as they are read. Chunks whose id and content are those of the version before keep what was computed for them.
    Chunk ids must be unique: building twice gives the same index, and a repeated id is an error that leaves the old one.
    """
    clash = sorted(set(OWN) & set(chunks.columns))
    if clash:
        raise ValueError(f"columns {clash} of the chunks have names of the index's own")
    name, dim = (model.name, model.dim) if model else (HASHED, dim)
    versions = _versions(spark, path)
    folder = f"versions/{uuid.uuid4().hex}"
    computed = "embedding" if model else "terms"
    rows = chunks.withColumn("digest", F.md5(content))
    known = F.lit(None).cast("array<float>" if model else TERMS_TYPE)
    if versions and (versions[0]["name"], versions[0]["dim"]) == (name, dim):
        old = spark.read.parquet(f"{path}/{versions[0]['folder']}/chunks")
        old = old.select(F.col(versions[0]["chunk_id"]).alias(chunk_id), "digest", F.col(computed).alias("__known"))
        rows = rows.join(old, [chunk_id, "digest"], "left")
        known = F.col("__known")
    rows = rows.withColumn("__known", known)
    if model:
        rows = embed_with(rows.withColumn("__new", F.when(F.col("__known").isNull(), F.col(content))), "__new", model, "__made")
        rows = rows.withColumn("embedding", F.coalesce("__known", "__made")).drop("__new", "__made")
    else:
        fresh = F.when(F.col("__known").isNull(), term_counts(F.col(content), dim))
        rows = rows.withColumn("terms", F.coalesce(F.col("__known"), fresh))
    # Ids near each other lie together, and a Bloom filter tells which row groups may hold one.
    writer = rows.drop("__known").sortWithinPartitions(chunk_id).write.option(f"parquet.bloom.filter.enabled#{chunk_id}", "true")
    writer.parquet(f"{path}/{folder}/chunks")
    written = spark.read.parquet(f"{path}/{folder}/chunks")
    repeated = written.groupBy(chunk_id).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"column {chunk_id!r} holds repeated ids")
    if not model:
        idf_table(written, "terms", dim).coalesce(1).write.parquet(f"{path}/{folder}/idf")
    row = [(versions[0]["version"] + 1 if versions else 1, folder, name, dim, chunk_id)]
    manifest = spark.createDataFrame(row, "version bigint, folder string, name string, dim int, chunk_id string")
    manifest.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    for version in versions[KEPT_VERSIONS - 1 :]:
        remove_folder(spark, f"{path}/{version['folder']}")
    return open_index(spark, path, model)


def open_index(spark: SparkSession, path: str, model: Embedder | None = None) -> Index:
    """Open the newest version; questions must be embedded by the same model as its chunks were."""
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no index at {path}")
    newest = versions[0]
    given = (model.name, model.dim) if model else (HASHED, newest["dim"])
    if given != (newest["name"], newest["dim"]):
        raise ValueError(f"the index holds vectors of {newest['name']} ({newest['dim']}), not of {given[0]} ({given[1]})")
    folder = f"{path}/{newest['folder']}"
    chunks = spark.read.parquet(f"{folder}/chunks")
    if model:
        square = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
        return Index(chunks.withColumn("norm", F.sqrt(square)), newest["name"], newest["dim"], None, model, folder, newest["chunk_id"])
    idf = spark.read.parquet(f"{folder}/idf")
    return Index(weigh(chunks, idf, "terms"), newest["name"], newest["dim"], idf, None, folder, newest["chunk_id"])


def embed_questions(questions: DataFrame, text: str, index: Index) -> DataFrame:
    """Question vectors by the index's own model, or with its dimension and idf weights."""
    if index.model:
        return embed_with(questions, text, index.model)
    terms = questions.withColumn("__terms", term_counts(F.col(text), index.dim))
    return weigh(terms, index.idf, "__terms").drop("__terms")


def _unit(df: DataFrame, sparse: bool) -> DataFrame:
    """Vectors at length 1; those without a length become null."""
    # The length is bound once: Catalyst would copy its sum over the vector into the function that is called for each element.
    if sparse:
        scaled = bind(F.col("norm"), lambda n: F.transform("embedding", lambda e: F.struct(e["bucket"], (e["weight"] / n).alias("weight"))))
    else:
        square = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
        df = df.withColumn("norm", F.sqrt(square))
        scaled = bind(F.col("norm"), lambda n: F.transform("embedding", lambda x: x / n))
    return df.withColumn("embedding", F.when(F.col("norm") > 0, scaled))


def retrieve(
    questions: DataFrame,
    index: Index,
    k: int = 4,
    question_id: str = "qid",
    text: str = "question",
    chunk_id: str = "chunk_id",
    way: str = "auto",
    metric: str = "cosine",
) -> DataFrame:
    """The ``k`` best chunks of every question: ``question_id, chunk_id, rk, score``.

    ``metric`` is ``cosine``, or ``l2`` or ``relevance`` (1 - d^2 / sqrt 2) of the vectors at length 1.
    """
    asked, chunks = embed_questions(questions.select(question_id, text), text, index), index.chunks
    if metric != "cosine":
        asked, chunks = (_unit(x, index.model is None) for x in (asked, chunks))
    return nearest(chunks, asked, k, metric, corpus_id=chunk_id, question_id=question_id, dim=index.dim, way=way)


def check_ids(questions: DataFrame, question_id: str) -> None:
    """Fail if two questions share an id: their hits would be mixed up."""
    named = questions.where(F.col(question_id).isNotNull())
    if not named.groupBy(question_id).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).isEmpty():
        raise ValueError(f"column {question_id!r} holds repeated ids")


def fetch(hits: DataFrame, index: Index, columns: list[str], chunk_id: str = "chunk_id") -> DataFrame:
    """Add columns of the hit chunks.

    The hits are written first, so the search runs once. The ids of up to ``FETCHED_IDS`` go to the scan as a filter: sorted ids
    and Bloom filters let it pass over the row groups without a hit. With more hits than that, a join finds them.
    """
    hits = stage(hits, "hits")
    few = hits.select(chunk_id).limit(FETCHED_IDS + 1).collect()
    if len(few) > FETCHED_IDS:
        return attach(hits, index.chunks, chunk_id, columns)
    chunks = index.chunks.select(chunk_id, *(c for c in columns if c != chunk_id))
    wanted = chunks.where(_is_one_of(chunk_id, sorted({r[chunk_id] for r in few})))
    return F.broadcast(hits).join(wanted, chunk_id)


def _is_one_of(column: str, values: list) -> Column:
    """``isin`` as one parsed text; thousands of single literals take seconds to hand over."""
    if not values:
        return F.lit(False)

    def literal(value: str | int) -> str:
        if isinstance(value, str):
            # a dollar sign would start a variable in Spark's SQL texts
            escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("$", "\\u0024")
            return f"'{escaped}'"
        return str(int(value))

    return F.expr(f"`{column}` IN ({', '.join(map(literal, values))})")


def caller_columns(index: Index) -> list[str]:
    """The columns of the chunks that the index was given."""
    return [c for c in index.chunks.columns if c not in OWN]


def retrieve_chunks(
    questions: DataFrame, index: Index, columns: list[str], k: int = 4, question_id: str = "qid",
    text: str = "question", chunk_id: str = "chunk_id", metric: str = "cosine", above: float | None = 0.0,
) -> DataFrame:
    """``retrieve`` with columns of the hit chunks and the question's text. Repeated question ids are an error.

    A hit by cosine needs a score over ``above``: at 0, one that shares no weighted term with the question is none.
    """
    check_ids(questions, question_id)
    hits = retrieve(questions, index, k, question_id, text, chunk_id, metric=metric)
    if above is not None and metric == "cosine":
        hits = hits.where(F.col("score") > above)
    return fetch(hits, index, columns, chunk_id).join(questions.select(question_id, text), question_id)
