"""N-gram Jaccard self-join by token-combination prefixes.

A document is the set of its word shingles; texts that are equal are joined first and stand for one. Shingles are ordered by how
many documents hold them, rare ones first (an exact exchange of packed counts tells). To be similar, two sets must agree
soon after the start of that order: if a set can lose ``n - ceil(t * n)`` shingles, its prefix is extended until, whatever
so many shingles are lost, one rare shingle or one combination of two frequent shingles of the same class is left.
Rare shingles are indexed by themselves, frequent ones by their pairs within each of ``CLASSES`` classes. A set so small that
it may have one frequent shingle in each class and no pair can only be similar to its equals and is indexed as a whole. Shingles that no other text has
fill the prefix first; a text with more of them than it can lose is compared with nothing.

Every bucket of the index compares all its texts with the one that has the least before its match, then, what is not
connected yet, with each other, as far as lengths and positions allow similarity; so a large group of
near copies is linked to its centre and not paired out, and no link between texts that are not connected otherwise
is lost. Candidates are verified on their shingles' hashes (at least 40 bits, by corpus size; see ``packed.plan``).

Nulls and odd input: null, empty and blank texts have an empty set and are linked with nothing but the texts that
equal them by a shared id; a text with fewer words than a shingle is one shingle. Rows that share an id share a node; a null id
gives a null component and no link. Columns other than ``doc_id`` and ``text`` are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm import packed
from passagework.llm.components import components
from passagework.llm.text import whole
from passagework.session import stage

FREQUENT = 64  # a shingle that more texts hold is indexed in combinations
CLASSES = 3
SIGNED = ["sig", "doc", "n", "before"]
SIGNED_ROWS = 20_000  # index entries given back at once
COMMON = 1_000  # keys that hold more than a thousandth of all rows, so no more than these, are joined by broadcast


def required(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The shingles a set of ``n`` must share with any similar set."""
    return (percent * n + 99) // 100


def classes_for(percent: int) -> int:
    """Classes of pairs cost a set one shingle each; so many that the smallest sets that can be linked still have a prefix."""
    smallest = percent // (100 - percent) if percent < 100 else CLASSES + 1
    return max(0, min(CLASSES, smallest - 1))


def signatures(keys: np.ndarray, held_by: np.ndarray, n: int, percent: int) -> list[tuple[int, int]]:
    """Index entries of one set: the hash and the number of shingles before it in the order that a similar set cannot hold if
    this is the first entry it shares. Of each class that has frequent ones before it, one may be shared without an entry.

    ``keys`` are the shingles that others hold too, in order; the other ``n - len(keys)`` come before them.
    """
    classes = classes_for(percent)
    alone = n - len(keys)
    if required(n, percent) <= classes:  # then it can lose none, nor can a similar set have more
        return [] if alone else [(hash(tuple(keys.tolist())) & (2**63 - 1), 0)]
    need = n - int(required(n, percent)) + 1 - alone
    out: list[tuple[int, int]] = []
    before: list[list[int]] = [[] for _ in range(classes)]
    for place, (key, df) in enumerate(zip(keys.tolist(), held_by.tolist())):
        if need <= 0:
            break
        if df <= FREQUENT or not classes:
            out.append((key, alone + place))
            need -= 1
            continue
        group = before[(key >> 40) % classes]
        out += [(hash((other, key)) & (2**63 - 1), alone + place - sum(map(bool, before))) for other in group]
        need -= bool(group)
        group.append(key)
    return out


def _sets(posts: DataFrame, answers: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, keys, held``: every text's number of shingles and, in order, those that others hold, with by how many (a rounded logarithm)."""

    def assemble(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        head = left[left["bucket"] < 0].iloc[0]
        ids, sizes = np.frombuffer(head["ids"], np.int64), np.frombuffer(head["sizes"], np.int64)
        told = dict(zip(right["bucket"], right["answer"]))
        docs, keys, held = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint8)]
        for bucket, per_key, at in zip(left["bucket"], left["rows"], left["at"]):
            if bucket in told:
                where, df, k = _shared(told[bucket], width)
                per_key = np.frombuffer(per_key, np.uint16).astype(np.int64)
                chosen = np.zeros(len(per_key), bool)
                chosen[where] = True
                docs.append(np.frombuffer(at, np.uint16)[np.repeat(chosen, per_key)].astype(np.int64))
                keys.append(np.repeat(k, per_key[where]))
                held.append(np.repeat(df, per_key[where]))
        doc, k, df = map(np.concatenate, (docs, keys, held))
        order = np.lexsort((k, df, doc))
        doc, k, df = doc[order], k[order], df[order]
        edges = np.searchsorted(doc, np.arange(len(ids) + 1))
        return pd.DataFrame(
            {
                "doc_id": ids, "n": sizes,
                "keys": [k[a:z].tobytes() for a, z in zip(edges, edges[1:])], "held": [df[a:z].tobytes() for a, z in zip(edges, edges[1:])],
            }
        )

    left = posts.select("block", "bucket", "rows", "at", "ids", "sizes")
    both = left.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInPandas(assemble, "doc_id bigint, n bigint, keys binary, held binary")


def _answer(width: int):
    def answer(keys: np.ndarray, total: np.ndarray) -> bytes:
        at = np.flatnonzero(total > 1).astype(np.uint32)
        df = np.minimum(255, np.ceil(8 * np.log2(np.maximum(total[at], 1)))).astype(np.uint8)
        return np.uint32(len(at)).tobytes() + at.tobytes() + df.tobytes() + packed.pack_keys(keys[at], width)

    return answer


def _shared(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    return (
        np.frombuffer(data, np.uint32, n, 4), np.frombuffer(data, np.uint8, n, 4 + 4 * n), packed.unpack_keys(data[4 + 5 * n :], width)
    )


@F.pandas_udf(T.LongType())
def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    each = (np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True) for x, y in zip(a, b))
    return pd.Series([len(x) for x in each], dtype=np.int64)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are similar: ``100 * both >= percent * either``."""
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("keys").alias(f"k_{c}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("both", _overlap("k_a", "k_b"))
    return met.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def common_keys(counted: DataFrame, key: str, rows: int) -> DataFrame:
    """``key`` of the rows of ``key, count`` that hold more than one in ``COMMON`` of ``rows``, but more than ``COMMON``: at most ``COMMON`` keys."""
    return counted.where(F.col("count") > max(COMMON, rows // COMMON)).select(key)


def join_common(left: DataFrame, right: DataFrame, key: str, common: DataFrame) -> DataFrame:
    """``left`` left-joined with ``right``, which has one row a key at most. Rows of the ``common`` keys stay where they are and meet the
    few rows of these keys by broadcast, so no task gets all rows of one key."""
    common = F.broadcast(common)
    few = F.broadcast(right.join(common, key, "left_semi"))
    spread = left.join(common, key, "left_semi").join(few, key, "left")
    return spread.unionByName(left.join(common, key, "left_anti").join(right, key, "left"))


def link(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc_id, same`` of all rows, ``doc_id, n`` of the texts that stand for their copies, and ``a, b`` of their links."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
    ids = stage(docs.select("doc_id", F.md5("text").alias("digest")), "digests")
    same = ids.groupBy("digest").agg(F.min("doc_id").alias("same"), F.count("*").alias("count")).where(F.col("count") > 1)
    same = stage(same, "same")
    members = join_common(ids, same.select("digest", "same"), "digest", common_keys(same, "digest", ids.count()))
    members = stage(members.select("doc_id", F.coalesce("same", "doc_id").alias("same")), "members")
    others = stage(members.where("doc_id <> same").select("doc_id").distinct(), "copies")
    alone = docs.where("doc_id is not null").join(others, "doc_id", "left_anti")
    bits, width = packed.plan(docs)
    posts = stage(packed.post(alone, lambda h, c: packed.shingles(h, c, words), bits, width), "shingles")
    answers = packed.totals(posts, width, _answer(width))
    sets = stage(_sets(posts, answers, width), "shared")

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list[tuple[int, int, int, int]] = []
            for doc, n, k, h in zip(f["doc_id"], f["n"], f["keys"], f["held"]):
                held_by = 2 ** (np.frombuffer(h, np.uint8) / 8)
                found = signatures(np.frombuffer(k, np.uint64) >> np.uint64(1), held_by, n, percent)
                rows += [(s, doc, n, before) for s, before in found]
                if len(rows) > SIGNED_ROWS:
                    yield pd.DataFrame(rows, columns=SIGNED).astype("int64")
                    rows = []
            yield pd.DataFrame(rows, columns=SIGNED).astype("int64")

    signed = stage(sets.where("length(keys) > 0").mapInPandas(sign, "sig bigint, doc bigint, n bigint, before bigint"), "signed")
    best = signed.groupBy("sig").agg(F.count("*").alias("c"), F.min(F.struct("before", "doc", "n")).alias("hub")).where("c > 1")
    bucket = stage(signed.join(best.select("sig", "hub"), "sig"), "buckets")

    def may(n_a: F.Column, p_a: F.Column, n_b: F.Column, p_b: F.Column) -> F.Column:
        return (100 + percent) * F.least(n_a - p_a, n_b - p_b) >= percent * (n_a + n_b)

    def pair(a: F.Column, b: F.Column) -> list[F.Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    hub = F.col("hub")
    first = bucket.where((F.col("doc") != hub["doc"]) & may(F.col("n"), F.col("before"), hub["n"], hub["before"]))
    links = stage(_verified(first.select(*pair(F.col("doc"), hub["doc"])).distinct(), sets, percent), "links")
    known = components(links).select(F.col("node").alias("doc"), "component")
    rest = bucket.where(F.col("doc") != hub["doc"]).join(known, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    open_ = rest.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = stage(rest.join(open_.select("sig"), "sig").select("sig", "doc", "n", "before", "component"), "open")
    x, y = rest.alias("x"), rest.alias("y")
    c = lambda n: F.col(n)
    second = x.join(
        y,
        (c("x.sig") == c("y.sig")) & (c("x.doc") < c("y.doc")) & (c("x.component") != c("y.component"))
        & may(c("x.n"), c("x.before"), c("y.n"), c("y.before")),
    ).select(c("x.doc").alias("a"), c("y.doc").alias("b")).distinct()
    links = links.unionByName(_verified(second, sets, percent)).distinct()
    return members, sets.select("doc_id", "n"), stage(links, "links")


def near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``docs``.

    Links are those between different texts that were found on the way to the components.
    """
    members, sizes, links = link(docs, words, percent)
    each = links.select("a").unionAll(links.select("b")).groupBy("a").agg(F.count("*").alias("n_links"))
    sizes = sizes.groupBy("doc_id").agg(F.max("n").alias("n"))
    known = sizes.join(components(links), sizes["doc_id"] == F.col("node"), "left").join(each, sizes["doc_id"] == each["a"], "left")
    known = stage(known.select(F.col("doc_id").alias("same"), "n", "component", F.coalesce("n_links", F.lit(0)).alias("n_links")), "known")
    out = join_common(members, known, "same", common_keys(members.groupBy("same").count(), "same", members.count()))
    empty = F.coalesce(F.col("n"), F.lit(0)) == 0
    return out.select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.coalesce("component", "same")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with only the document of the smallest id of each component; ids of null come last.

    A document is its id and its text: rows without an id or with a shared one are told apart by their texts, and rows that repeat
    both are one. Texts without words are linked with nothing, so they stay. Ids may have any type.
    """
    named = docs.withColumn("__node", F.xxhash64("doc_id", F.col("text").isNull(), "text"))
    classes = near_copies(named.select(F.col("__node").alias("doc_id"), "text"), words, percent)
    classes = classes.select(F.col("doc_id").alias("__node"), "component_id").distinct()
    each = named.select("__node", "doc_id").join(classes, "__node")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__node")).alias("first")
    kept = each.groupBy("component_id").agg(first).select(F.col("first.__node").alias("__node"))
    return named.join(kept, "__node", "left_semi").dropDuplicates(["__node"]).drop("__node")
