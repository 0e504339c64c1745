"""The neighbour join against brute force, both ways, with ties, copies, zero vectors and small corpora."""

import math

import numpy as np
import pyarrow as pa
import pytest

from passagework.operators import nearest as N
from passagework.operators.ranking import latest, latest_per_key, top_k
from pyspark.sql import functions as F

SCHEMA = "{} {}, embedding array<float>"


def vectors(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dim)).astype(np.float32)
    if copies:
        rows[:copies] = rows[0]
    return rows


def frame(spark, rows, name, kind="long"):
    key = (lambda i: f"id-{i}") if kind == "string" else (lambda i: i)
    data = [(key(i), None if r is None else [float(x) for x in r]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA.format(name, kind))


def brute(corpus, questions, k, metric, key=lambda i: i):
    out = {}
    for q, a in enumerate(questions):
        scored = []
        for i, b in enumerate(corpus):
            a64, b64 = np.asarray(a, dtype=np.float64), np.asarray(b, dtype=np.float64)
            if metric == "cosine":
                norm = math.sqrt((a64 @ a64) * (b64 @ b64))
                if norm == 0:
                    continue
                score = round(float(a64 @ b64) / norm, 6)
                order = -score
            else:
                order = round(float(np.linalg.norm(a64 - b64)), 6)
                score = order
                if metric == "relevance":
                    score = round(1 - float((a64 - b64) @ (a64 - b64)) / math.sqrt(2), 6)
                    order = -score
            scored.append((order, key(i), score))
        out[q] = [(i, s) for _, i, s in sorted(scored)[:k]]
    return {q: hits for q, hits in out.items() if hits}


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r[0], r.rk)):
        out.setdefault(r[0], []).append((r[1], round(r.score, 6)))
        assert r.rk == len(out[r[0]])
    return out


@pytest.mark.parametrize("metric", N.METRICS)
@pytest.mark.parametrize("way", ["scan", "stream", "grid"])
def test_equals_brute_force(spark, metric, way):
    corpus, questions = vectors(300, 8, 1, copies=100), vectors(30, 8, 2)
    questions[0] = corpus[0]
    found = N.nearest(
        frame(spark, corpus, "id").repartition(5), frame(spark, questions, "qid"), 7, metric, way=way
    )
    wanted = brute(corpus, questions, 7, metric)
    got = collected(found)
    assert {q: [i for i, _ in h] for q, h in got.items()} == {q: [i for i, _ in h] for q, h in wanted.items()}
    for q, hits in wanted.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in hits], abs=2e-6)


@pytest.mark.parametrize("way", ["scan", "stream", "grid"])
def test_many_blocks(spark, monkeypatch, way):
    for name, value in (("CELL_SCORES", 50), ("GRID_QUESTIONS", 4), ("GRID_CORPUS", 16), ("STREAM_QUESTIONS", 3), ("STREAM_VALUES", 40), ("WIDE_CLUSTER", 1)):
        monkeypatch.setattr(N, name, value)
    corpus, questions = vectors(90, 4, 3, copies=30), vectors(11, 4, 4)
    found = N.nearest(frame(spark, corpus, "id"), frame(spark, questions, "qid"), 5, way=way)
    assert collected(found) == brute(corpus, questions, 5, "cosine")


@pytest.mark.parametrize("way", ["scan", "stream", "grid"])
def test_string_ids_ties_zero_and_null_vectors(spark, way):
    corpus = [[1, 0], [0, 0], [2, 0], None, [0, 1], [3, 0], [-1, 0]]
    questions = [[1, 0], [0, 0], None]
    found = N.nearest(
        frame(spark, corpus, "id", "string"), frame(spark, questions, "qid"), 10, way=way
    )
    # Equal scores in the order of their ids; k above the corpus gives the whole of it.
    assert collected(found) == {0: [("id-0", 1.0), ("id-2", 1.0), ("id-5", 1.0), ("id-4", 0.0), ("id-6", -1.0)]}


@pytest.mark.parametrize("way", ["scan", "stream", "grid"])
def test_sparse(spark, way):
    rng = np.random.default_rng(5)

    def sparse(n, name):
        rows = []
        for i in range(n):
            buckets = sorted(rng.choice(50, size=int(rng.integers(0, 9)), replace=False).tolist())
            rows.append((i, [(int(b), float(rng.uniform(0.1, 2))) for b in buckets]))
        schema = f"{name} long, embedding array<struct<bucket:int,weight:double>>"
        dense = np.zeros((n, 50))
        for i, pairs in rows:
            for b, w in pairs:
                dense[i, b] = w
        return spark.createDataFrame(rows, schema), dense

    corpus, dense_corpus = sparse(120, "id")
    questions, dense_questions = sparse(20, "qid")
    for metric in ("cosine", "l2"):
        found = N.nearest(corpus.repartition(3), questions, 6, metric, dim=50, way=way)
        wanted = brute(dense_corpus, dense_questions, 6, metric)
        assert collected(found) == {q: h for q, h in wanted.items()}


def test_oversized_questions_stream_past_the_corpus(spark, monkeypatch):
    """No exchange and no count of the corpus: below the Python step there is its scan alone."""
    monkeypatch.setattr(N, "SCAN_ROWS", 10)
    corpus, questions = frame(spark, vectors(20, 4, 6), "id"), frame(spark, vectors(11, 4, 7), "qid")
    wanted = collected(N.nearest(corpus, questions, 2, way="stream"))
    counted = []
    monkeypatch.setattr(type(corpus), "count", lambda df: counted.append(df))
    found = N.nearest(corpus, questions, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapCoGroups" not in plan and "Exchange" not in plan[plan.index("MapInArrow") :] and not counted
    monkeypatch.undo()
    assert collected(found) == wanted
    monkeypatch.setattr(N, "SCAN_ROWS", 10)
    with pytest.raises(ValueError):
        N.nearest(corpus, questions, 2, way="scan")
    few = N.nearest(corpus, questions.limit(10), 2)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in few and "FlatMapCoGroups" not in few


def test_storage_that_python_cannot_open(spark, monkeypatch):
    monkeypatch.setattr(N, "SCAN_ROWS", 10)
    monkeypatch.setattr(N, "readable", lambda path: False)
    corpus, questions = frame(spark, vectors(20, 4, 6), "id"), frame(spark, vectors(11, 4, 7), "qid")
    found = N.nearest(corpus, questions, 2)
    assert "FlatMapCoGroups" in found._jdf.queryExecution().executedPlan().toString()
    assert collected(found) == collected(N.nearest(corpus, questions, 2, way="grid"))
    with pytest.raises(ValueError):
        N.nearest(corpus, questions, 2, way="stream")


@pytest.mark.parametrize("way", ["scan", "stream", "grid"])
def test_own_rows_can_be_skipped(spark, way):
    rows = vectors(40, 4, 9, copies=10)
    found = N.nearest(frame(spark, rows, "id"), frame(spark, rows, "qid"), 3, way=way, skip_same_id=True)
    wanted = {q: [h for h in hits if h[0] != q][:3] for q, hits in brute(rows, rows, 4, "cosine").items()}
    assert collected(found) == wanted


def test_bad_arguments(spark):
    df = frame(spark, vectors(3, 4, 8), "id")
    other = frame(spark, vectors(3, 5, 8), "qid")
    for bad in ({"metric": "dot"}, {"k": 0}, {"way": "both"}, {"corpus_id": "qid"}):
        with pytest.raises(ValueError):
            N.nearest(df, other, **bad)
    with pytest.raises(Exception, match="dimensions differ"):
        N.nearest(df, other).collect()


def test_no_corpus_or_no_questions(spark):
    df, other = frame(spark, vectors(3, 4, 8), "id"), frame(spark, vectors(3, 4, 8), "qid")
    for way in ("scan", "stream", "grid"):
        assert N.nearest(df.limit(0), other, way=way).collect() == []
        assert N.nearest(df, other.limit(0), way=way).collect() == []


def test_top_k_with_a_hot_key(spark):
    df = spark.range(6000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    df = df.union(spark.range(6000, 9000).selectExpr("0L", "id"))
    for k in (3, 1500):
        rows = top_k(df, ["k"], [F.col("v").desc()], k).collect()
        for key in range(3):
            values = sorted((r.v for r in rows if r.k == key), reverse=True)
            wanted = [v for v in range(9000 - 1, -1, -1) if (v >= 6000 and key == 0) or (v < 6000 and v % 3 == key)]
            assert values == wanted[:k]


def test_latest(spark):
    rows = [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), ("b", 0, 5)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    assert sorted(tuple(r) for r in latest_per_key(df, ["k"], "t", ["id"]).collect()) == [("a", 2, 3), ("b", 0, 5)]
    assert tuple(latest(df, "t", ["id"]).first()) == ("a", 2, 3)


@pytest.mark.parametrize("way", ["scan", "stream", "grid"])
@pytest.mark.parametrize("metric", ["cosine", "l2", "relevance"])
def test_vectors_without_a_score_erase_nothing(spark, metric, way):
    bad = [(10, [None, 1.0]), (11, [float("nan"), 0.0]), (12, [float("inf"), 1.0])]
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), *bad]
    corpus = spark.createDataFrame(rows, "vec_id int, embedding array<double>").coalesce(1)
    questions = spark.createDataFrame([(1, [1.0, 0.1]), (2, [float("nan"), 1.0])], "qid int, embedding array<double>")
    out = N.nearest(corpus, questions, 2, metric, corpus_id="vec_id", question_id="qid", way=way).collect()
    assert sorted((r.qid, r.vec_id) for r in out) == [(1, 1), (1, 2)]


@pytest.mark.parametrize("metric", ["l2", "relevance"])
def test_rows_that_share_no_bucket_need_no_gaps(monkeypatch, metric):
    """A whole corpus equally far from a question: no row is filled up, and the smallest ids win in any order of the rows."""
    n, dim, k = 4_000, 4_096, 2
    compared = []
    gaps = N._Sparse.exact_square
    monkeypatch.setattr(N._Sparse, "exact_square", lambda self, other, i, j: compared.append(len(i)) or gaps(self, other, i, j))

    def rows(buckets):
        return N._Sparse(pa.array([[{"bucket": b, "weight": w} for b, w in row] for row in buckets]), dim)

    corpus = [[(i % 50, 0.6), (50 + i % 7, 0.8)] for i in range(n)]
    questions = [[(4_000, 1.0)], [(3, 0.6), (53, 0.8)], [(9, 1.0)]]
    best = N._Best(rows(questions), k, metric)
    ids = np.array([b"c%05d" % i for i in range(n)])
    for part in np.array_split(np.arange(n)[::-1], 3):
        best.add(ids[part], rows([corpus[i] for i in part]))
    assert sum(compared) < n / 4
    sign = -1 if metric == "l2" else 1
    found = {}
    for q, i, s in zip(*best.rows()):
        found.setdefault(int(q), []).append((i, round(sign * s, 6)))
    dense = lambda row: np.bincount([b for b, _ in row], [w for _, w in row], dim)
    assert found == brute([dense(r) for r in corpus], [dense(r) for r in questions], k, metric, key=lambda i: ids[i])
