"""Batch scoring, its contract, joins of scores, stand-ins, retrieval and answers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.operators import chunking as C
from passagework.operators import embedding as B
from passagework.operators import retrieval as R
from passagework.operators import scoring as S
from passagework.plans import registry
from passagework.plans.qa import answer
from passagework.session import scratch_path


def upper():
    return S.Scorer("upper", lambda: lambda texts: [t.upper() for t in texts])


def test_batch_score(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, t string").repartition(2)
    out = S.batch_score(df, upper(), ["t"], "o")
    assert sorted(map(tuple, out.collect())) == [(1, "a", "A"), (2, None, None), (3, "c", "C")]


def test_batch_score_with_several_inputs(spark):
    scorer = S.Scorer(
        "scale", lambda: lambda a, b: [x * y for x, y in zip(a, b)], (T.DoubleType(), T.DoubleType()), T.DoubleType()
    )
    df = spark.createDataFrame([(1.5, 2.0), (None, 1.0)], "a double, b double")
    assert sorted(S.batch_score(df, scorer, ["a", "b"], "o").collect(), key=str) == [(1.5, 2.0, 3.0), (None, 1.0, None)]


def test_batches_of_like_length(spark):
    """Each batch costs its longest text times its rows, at most the budget; keys may repeat, nulls are not scored."""
    rows = [(i % 30, " ".join(["w"] * (i * 37 % 41))) for i in range(200)] + [(5, None), (6, "long " * 500), (7, "")]
    cost = S.Scorer("cost", lambda: lambda texts: [f"{len(texts)} {max(len(t.split()) for t in texts)}" for t in texts])
    df = spark.createDataFrame(rows, "id int, t string").repartition(3)
    out = S.batch_score_by_length(df, cost, "id", "t", "o", 60)
    assert out.columns == ["id", "o"]
    found = out.collect()
    assert sorted(r.id for r in found) == sorted(i for i, _ in rows)
    costs = [tuple(map(int, r.o.split())) for r in found if r.o]
    assert len(costs) == len(rows) - 1 and all(n * most <= 60 or n == 1 for n, most in costs) and max(n for n, _ in costs) > 3


def test_contract(spark):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    with pytest.raises(TypeError):
        S.batch_score(df, upper(), ["id"], "o")
    with pytest.raises(ValueError):
        S.batch_score(df, upper(), ["t", "t"], "o")
    short = S.Scorer("short", lambda: lambda texts: [])
    with pytest.raises(Exception, match="0 results for 1 rows"):
        S.batch_score(df, short, ["t"], "o").collect()


def test_scores_join_by_key_not_position(spark):
    inputs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, t string")
    scored = spark.createDataFrame([(3, "C"), (1, "A")], "id int, o string")
    assert sorted(map(tuple, S.join_scores(inputs, scored, "id").collect())) == [(1, "a", "A"), (2, "b", None), (3, "c", "C")]


def test_rename_must_hit(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert S.rename_column(df, "a", "b").columns == ["b"]
    with pytest.raises(ValueError):
        S.rename_column(df, "x", "b")
    with pytest.raises(ValueError):
        S.rename_column(df.withColumn("b", F.lit(1)), "a", "b")


def test_prompt_and_score(spark):
    df = spark.createDataFrame([("hi {q}",)], "q string")
    out = S.prompt_and_score(df, "Say: {q}", upper(), {"q": F.col("q")}, "Response")
    assert out.columns == ["q", "Response"] and out.first()[1] == "SAY: HI {Q}"


def test_summary(spark):
    rows = [(1, "One two. two three three!\nFour."), (2, "..."), (3, None), (4, "A. B.")]
    out = S.extractive_summary(spark.createDataFrame(rows, "id int, t string"), "id", "t")
    assert sorted(map(tuple, out.collect())) == [
        (1, "two three three!", 6), (2, None, None), (3, None, None), (4, "A.", 1),
    ]


def test_best_sentence(spark):
    def best(context, question):
        df = spark.createDataFrame([(context, question)], "c string, q string")
        return df.select(S.best_sentence(F.col("c"), F.col("q"))).first()[0]

    assert best("Red fox. A blue whale. The blue fox.", "blue fox?") == "The blue fox."
    assert best("First. Second.", "none") == "First."
    assert best("...", "x") is None


def test_vote_and_abstain(spark):
    hits = spark.createDataFrame(
        [(1, 10, 1, 0.9), (1, 11, 2, 0.8), (1, 12, 3, 0.7), (2, 11, 1, 0.2), (2, 12, 2, 0.1)],
        "qid int, id int, rk int, score double",
    )
    labels = spark.createDataFrame([(10, 7), (11, 5), (12, 5)], "id int, label int")
    assert sorted(map(tuple, S.vote(hits, labels, "qid", "id", "label").collect())) == [(1, 5, 2), (2, 5, 2)]
    out = S.abstain(hits, "qid", "score", 0.5, F.min_by("id", "rk").cast("string"), "unknown")
    assert sorted(map(tuple, out.collect())) == [(1, 0.9, "10"), (2, 0.2, "unknown")]


def test_term_counts(spark):
    df = spark.createDataFrame([("b a b",), ("",), (None,)], "t string")
    rows = [r[0] for r in df.select(B.term_counts(F.col("t"))).collect()]
    import hashlib

    bucket = {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 4096 for w in "ab"}
    assert [tuple(x) for x in rows[0]] == sorted([(bucket["a"], 1), (bucket["b"], 2)])
    assert rows[1] == [] and rows[2] is None


def test_model_vectors(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "c")], "id int, t string")
    out = B.embed_with(df, "t", B.Embedder("length", lambda: lambda texts: [[float(len(t)), 1.0] for t in texts], 2))
    assert {r.id: r.embedding for r in out.collect()} == {1: [2.0, 1.0], 2: None, 3: [1.0, 1.0]}
    with pytest.raises(Exception, match="one vector of 3 values"):
        B.embed_with(df, "t", B.Embedder("bad", lambda: lambda texts: [[1.0]] * len(texts), 3)).collect()


def test_index_of_a_model(spark):
    letters = B.Embedder("letters", lambda: lambda texts: [[t.count("a"), t.count("b")] for t in texts], 2)
    rows = [("c1", "aaaa"), ("c2", "bbb"), ("c3", "ab"), ("c4", "zzz")]
    path = scratch_path(spark, "test-model")
    index = R.build_index(spark, spark.createDataFrame(rows, "chunk_id string, content string"), path, model=letters)
    assert {r.chunk_id: r.norm for r in index.chunks.collect()} == pytest.approx({"c1": 4, "c2": 3, "c3": 2**0.5, "c4": 0})
    questions = spark.createDataFrame([(1, "aab"), (2, "b"), (3, "none")], "qid int, question string")
    found = R.retrieve(questions, R.open_index(spark, path, letters), 2)
    assert sorted((r.qid, r.rk, r.chunk_id) for r in found.collect()) == [
        (1, 1, "c3"), (1, 2, "c1"), (2, 1, "c2"), (2, 2, "c3"),
    ]
    for other in (None, B.Embedder("letters", letters.load, 3), B.Embedder("other", letters.load, 2)):
        with pytest.raises(ValueError):
            R.open_index(spark, path, other)


def test_index_is_idempotent_and_rejects_repeated_ids(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    chunks = C.chunk_text(docs, "text", ["doc_id"]).withColumn("chunk_id", R.chunk_key("doc_id"))
    path = scratch_path(spark, "test-index")
    digest = []
    for _ in range(2):
        index = R.build_index(spark, chunks, path)
        rows = index.chunks.select(F.xxhash64("chunk_id", F.to_json("embedding"), "norm").alias("h"))
        digest.append((rows.count(), rows.agg(F.bit_xor("h")).first()[0]))
    assert digest[0] == digest[1] and digest[0][0] == chunks.count()
    assert (index.name, index.dim) == (R.HASHED, B.DIM)
    with pytest.raises(ValueError):
        R.build_index(spark, chunks.unionAll(chunks.limit(1)), scratch_path(spark, "test-index"))


def test_both_ways_retrieve_the_same(spark, sf):
    index, questions = registry._index(spark, sf), registry._questions(spark, sf).where("qid >= 0 AND qid < 1000000000")
    rows = [sorted(map(tuple, R.retrieve(questions, index, 5, way=way).collect())) for way in ("scan", "grid")]
    assert rows[0] == rows[1] and len(rows[0]) == 5 * questions.count()


def test_known_passages_are_found(spark):
    """Passages that occur word for word in a document: the right document is among the first ten."""
    sf = "/root/testdata/sf0.01"
    found = registry.retrieve_passages(spark, sf).select("qid", "doc_id").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    hits, known = 0, 0
    for q in registry._questions(spark, sf).collect():
        holders = {d.doc_id for d in docs if q.question in d.text}
        if holders:
            known += 1
            hits += bool(holders & {r.doc_id for r in found if r.qid == q.qid})
    assert known >= 15 and hits / known >= 0.95


def test_answers_with_a_scorer(spark, sf):
    index, questions = registry._index(spark, sf), registry._questions(spark, sf).where("qid >= 0 AND qid < 1000000000")
    length = S.Scorer("length", lambda: lambda prompts: [str(len(p)) for p in prompts])
    rows = answer(questions, index, "doc_id", "{context}|{question}", k=2, scorer=length).collect()
    assert len(rows) == questions.count()
    for r in rows:
        assert r.output_text == str(len(r.prompt))
        assert [d.rk for d in r.input_documents] == [1, 2]
        assert r.question in r.prompt and all(d.content in r.prompt for d in r.input_documents)
