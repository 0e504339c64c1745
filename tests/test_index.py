"""Versions of an index, what a rebuild computes, what a fetch reads, and the inverted index against the full scan."""

import os

import pytest
from pyspark.sql import functions as F

from passagework.operators import embedding as B
from passagework.operators import inverted as V
from passagework.operators import retrieval as R
from passagework.plans import prompts, registry
from passagework.plans.qa import answer
from passagework.session import scratch_path

DDL = "chunk_id string, content string, page string"
ROWS = [(f"c{i:03}", f"common words and word{i % 7} with thing{i} for page {i % 11}", f"p{i % 11}") for i in range(120)]


def chunks(spark, rows=ROWS):
    return spark.createDataFrame(rows, DDL)


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid int, question string")


def contents(index):
    return sorted((r.chunk_id, r.content, r.page) for r in index.chunks.collect())


def test_a_rebuild_that_stops_half_way_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "versions")
    R.build_index(spark, chunks(spark), path)
    with monkeypatch.context() as broken:
        broken.setattr(R, "idf_table", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            R.build_index(spark, chunks(spark, ROWS[:5]), path)
    with pytest.raises(ValueError, match="repeated"):
        R.build_index(spark, chunks(spark, ROWS + ROWS[:1]), path)
    assert contents(R.open_index(spark, path)) == ROWS
    R.build_index(spark, chunks(spark, ROWS[:5]), path)
    assert contents(R.open_index(spark, path)) == ROWS[:5]


def test_old_versions_go(spark):
    path = scratch_path(spark, "versions")
    for n in (3, 4, 5, 6):
        index = R.build_index(spark, chunks(spark, ROWS[:n]), path)
    assert spark.read.parquet(f"{path}/manifest").count() == 4
    assert len(os.listdir(f"{path}/versions")) == R.KEPT_VERSIONS
    assert contents(index) == ROWS[:6]
    with pytest.raises(ValueError, match="no index"):
        R.open_index(spark, scratch_path(spark, "nothing"))


def test_an_index_may_be_rebuilt_from_itself(spark):
    path = scratch_path(spark, "versions")
    index = R.build_index(spark, chunks(spark), path)
    again = R.build_index(spark, index.chunks.select("chunk_id", "content", "page").where("page <> 'p3'"), path)
    assert contents(again) == [r for r in ROWS if r[2] != "p3"]


def test_only_changed_chunks_are_embedded(spark):
    marks = scratch_path(spark, "marks")
    os.makedirs(marks)

    def load():
        def embed(texts):
            for t in texts:
                open(f"{marks}/{t}", "w").close()
            return [[float(len(t)), 1.0] for t in texts]

        return embed

    model, path = B.Embedder("length", load, 2), scratch_path(spark, "versions")
    first = [("a", "one", "p"), ("b", "three", "p"), ("c", "seven", "p")]
    R.build_index(spark, chunks(spark, first), path, model=model)
    for name in os.listdir(marks):
        os.remove(f"{marks}/{name}")
    index = R.build_index(spark, chunks(spark, [("a", "one", "q"), ("b", "eleven", "p"), ("d", "four", "p")]), path, model=model)
    assert sorted(os.listdir(marks)) == ["eleven", "four"]
    assert {r.chunk_id: (r.page, r.embedding[0]) for r in index.chunks.collect()} == {"a": ("q", 3), "b": ("p", 6), "d": ("p", 4)}


def test_reused_term_counts_equal_fresh_ones(spark):
    path = scratch_path(spark, "versions")
    R.build_index(spark, chunks(spark), path)
    changed = [(i, c + " more" if i < "c010" else c, p) for i, c, p in ROWS[:90]]
    rows = lambda index: sorted(map(str, index.chunks.select("chunk_id", "terms", "embedding").collect()))
    again = R.build_index(spark, chunks(spark, changed), path)
    assert rows(again) == rows(R.build_index(spark, chunks(spark, changed), scratch_path(spark, "fresh")))


def test_names_of_the_index_are_refused(spark):
    with pytest.raises(ValueError, match="digest"):
        R.build_index(spark, chunks(spark).withColumn("digest", F.lit(1)), scratch_path(spark, "clash"))


def rows_scanned(df):
    """Rows that the scan of the chunks gave back, whole row groups at a time."""
    df.collect()

    def scans(plan):
        name = plan.nodeName()
        if "Scan parquet" in name and "content" in plan.simpleString(1000):
            return [plan]
        if "Adaptive" in name:
            return scans(plan.executedPlan())
        if "QueryStage" in name:
            return scans(plan.plan())
        children = plan.children()
        return [s for i in range(children.size()) for s in scans(children.apply(i))]

    return sum(s.metrics().apply("numOutputRows").value() for s in scans(df._jdf.queryExecution().executedPlan()))


def test_a_fetch_reads_only_row_groups_with_hits(spark, monkeypatch):
    rows = [(f"k{i * 7919 % 4000:04}", f"text{i} of many", "p") for i in range(4000)]
    index = R.build_index(spark, chunks(spark, rows).repartition(40), scratch_path(spark, "groups"))
    hits = spark.createDataFrame([(1, "k0007", 1, 0.5), (1, "k3000", 2, 0.4), (2, "k0007", 1, 0.1)], "qid int, chunk_id string, rk int, score double")
    found = R.fetch(hits, index, ["content"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(chunk_id, [k0007,k3000])" in plan
    wanted = {i: c for i, c, _ in rows}
    assert sorted((r.qid, r.chunk_id, r.content) for r in found.collect()) == sorted((q, i, wanted[i]) for q, i in ((1, "k0007"), (1, "k3000"), (2, "k0007")))
    # of 40 files in no order of ids, the Bloom filters leave the two that hold an id and rarely another
    assert 0 < rows_scanned(found) <= 500
    monkeypatch.setattr(R, "FETCHED_IDS", 1)
    assert sorted(map(str, R.fetch(hits, index, ["content"]).select(*found.columns).collect())) == sorted(map(str, found.collect()))


def test_ids_of_any_text_are_fetched(spark):
    rows = [("it's", "one", "p"), ('a"b\\c', "two", "p"), ("${x}\n%", "three", "p"), ("é", "four", "p")]
    index = R.build_index(spark, chunks(spark, rows), scratch_path(spark, "odd"))
    hits = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "qid int, chunk_id string")
    assert sorted((r.chunk_id, r.content) for r in R.fetch(hits, index, ["content"]).collect()) == sorted(r[:2] for r in rows)


def test_no_hits_fetch_nothing(spark):
    index = R.build_index(spark, chunks(spark), scratch_path(spark, "none"))
    found = R.retrieve_chunks(asked(spark, "zebra quark", "..."), index, ["content"])
    assert found.columns == ["chunk_id", "qid", "rk", "score", "content", "question"] or "content" in found.columns
    assert found.count() == 0


# --- the inverted index ------------------------------------------------------------------------------


def full_scan(questions, index, k):
    return sorted(map(tuple, R.retrieve(questions, index, k).where("score > 0").collect()))


@pytest.mark.parametrize("k", [1, 3, 40])
@pytest.mark.parametrize("block", [2, 1024])
def test_postings_give_the_rows_of_the_full_scan(spark, monkeypatch, k, block):
    """Few words and many copies, so blocks are many and scores tie."""
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "SEEDS", 1)
    index = R.build_index(spark, chunks(spark, ROWS + [(f"x{i}", ROWS[3][1], "p") for i in range(30)]), scratch_path(spark, "inv"))
    postings = V.write_postings(index, scratch_path(spark, "postings"), block)
    questions = asked(spark, "word3 thing7", "common words", "thing1 thing2 thing3 page 4 and word5", "none", "", ROWS[3][1])
    found = V.retrieve_by_postings(questions, index, postings, k)
    assert found.columns == ["qid", "chunk_id", "rk", "score"]
    assert sorted(map(tuple, found.collect())) == full_scan(questions, index, k)


def test_fewer_postings_are_read(spark, sf):
    """For all benchmark questions on the documents' chunks."""
    index, k = registry._index(spark, sf), 2
    postings = V.write_postings(index, scratch_path(spark, "postings"))
    assert postings.levels.agg(F.sum("n")).first()[0] == postings.blocks.agg(F.sum(F.size("entries"))).first()[0]
    questions = registry._questions(spark, sf)
    ready = V.prepared(questions, index, "qid", "question")
    terms = V.question_terms(ready, postings)
    levels = V.needed_levels(terms, V._bars(terms, ready, index, postings, k))
    every, read = levels.agg(F.sum("n"), F.sum(F.when(F.col("read"), F.col("n")))).first()
    assert read < 0.8 * every
    assert sorted(map(tuple, V.retrieve_by_postings(questions, index, postings, k).collect())) == full_scan(questions, index, k)


def test_products_are_summed_where_postings_lie(spark):
    """Frequent words: each question meets most chunks, but a shard returns k of them at most."""
    rows = [(f"m{i:04}", f"alpha beta gamma delta w{i % 9} v{i % 13} u{i}", "p") for i in range(600)] + [(f"n{i}", "zeta", "p") for i in range(600)]
    index, k = R.build_index(spark, chunks(spark, rows), scratch_path(spark, "inv")), 3
    postings = V.write_postings(index, scratch_path(spark, "postings"), 200)
    questions = asked(spark, *(f"alpha beta w{i % 9} gamma v{i % 13} delta" for i in range(20)))
    ready = V.prepared(questions, index, "qid", "question")
    terms = V.question_terms(ready, postings)
    levels = V.needed_levels(terms, V._bars(terms, ready, index, postings, k))
    met = V._meet(levels, postings, 20, k)
    shards = postings.blocks.agg(F.max("part") + 1).first()[0]
    assert shards > 1 and k * 20 <= met.count() <= k * 20 * shards
    assert sorted(map(tuple, V.retrieve_by_postings(questions, index, postings, k).collect())) == full_scan(questions, index, k)


def test_postings_need_weights_above_zero(spark):
    model = B.Embedder("length", lambda: lambda texts: [[1.0, -1.0] for t in texts], 2)
    index = R.build_index(spark, chunks(spark, ROWS[:3]), scratch_path(spark, "inv"), model=model)
    with pytest.raises(ValueError):
        V.write_postings(index, scratch_path(spark, "postings"))


# --- questions and answers ---------------------------------------------------------------------------


def test_answers(spark):
    index = R.build_index(spark, chunks(spark, [("a", "Red fox jumps. It is quick.", "p1"), ("b", "Blue whale swims.", "p2"), ("c", "Green tree.", "p3")]), scratch_path(spark, "qa"))
    questions = asked(spark, "the red fox", "zebra quark", None, "")
    rows = {r.qid: r for r in answer(questions, index, "page", prompts.FROM_PASSAGES).collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert [tuple(d.metadata) for d in rows[0].input_documents] == [("a", "p1")] and rows[0].output_text == "Red fox jumps."
    for i in (1, 2, 3):
        assert rows[i].input_documents == [] and rows[i].output_text == "I do not know." and rows[i].prompt is not None
    # a threshold of its own lets chunks in that share nothing
    loose = {r.qid: r for r in answer(questions, index, "page", prompts.FROM_PASSAGES, min_score=-1.0).collect()}
    assert len(loose[0].input_documents) == 2


def test_questions_that_share_an_id_are_refused(spark):
    index = R.build_index(spark, chunks(spark, ROWS[:5]), scratch_path(spark, "qa"))
    twice = spark.createDataFrame([(1, "word1"), (1, "word2")], "qid int, question string")
    for run in (lambda: answer(twice, index, "page", prompts.FROM_PASSAGES), lambda: R.retrieve_chunks(twice, index, ["content"])):
        with pytest.raises(ValueError, match="repeated"):
            run()


def test_no_chunk_above_the_limit(spark, sf):
    from passagework.functions.text import token_count

    n = registry._index(spark, sf).chunks.agg(F.max(token_count(F.col("content")))).first()[0]
    assert n <= 400
    for query in (registry.html_chunks, registry.text_chunks):
        assert query(spark, sf).agg(F.max("n_tokens")).first()[0] <= 400
