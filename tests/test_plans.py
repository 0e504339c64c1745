"""What the physical plans must and must not contain, and the incremental ingest."""

import re

import pytest
from pyspark.sql import functions as F

from passagework.plans import registry
from passagework.session import scratch_path
from passagework.streaming.ingest import stream_page_chunks

OPTIONS = {"native": True, "mark": "p", "titled": False}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


WRITE_FIRST = {"stream_ingest", "xml_rows", "sitemap_urls", "table_overwrite", "index_roundtrip", "retrieve_inverted", "payload_left_join"}
LAZY = sorted(set(registry.QUERIES) - WRITE_FIRST)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, sf, name):
    plan = plan_of(registry.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["section_merge", "token_windows", "extractive_summary", "hash_embed"])
def test_stays_in_the_jvm(spark, sf, name):
    assert not re.search(r"ArrowEvalPython|MapIn|FlatMap", plan_of(registry.QUERIES[name](spark, sf)))


def test_costly_expressions_run_once(spark, sf):
    assert plan_of(registry.article_extract(spark, sf)).count("ArrowEvalPython") == 1
    assert plan_of(registry.section_merge(spark, sf)).count("aggregate(") == 1
    assert plan_of(registry.html_chunks(spark, sf)).count("ArrowEvalPython") == 1


def test_only_overlong_words_leave_the_jvm(spark):
    """The splitter's Python step gets null for every text that has blanks to split at."""
    from passagework.operators import chunking as C

    df = spark.createDataFrame([(1, "word " * 3000), (2, "a-" * 900 + " b"), (3, "few words"), (4, "x" * 5000)], "id int, t string")
    seen = spark.sparkContext.accumulator(0)
    plain = C.split_spans

    def counted(*args):
        seen.add(1)
        return plain(*args)

    C.split_spans = counted
    try:
        C.explode_chunks(df.select("id", C.whole_text(F.col("t")).alias("w")), C.split_long(F.col("w")), ["id"]).collect()
    finally:
        C.split_spans = plain
    assert seen.value == 2


def test_scans_read_only_what_they_need(spark, sf):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan_of(registry.token_count(spark, sf))
    plan = plan_of(registry.prompt_support(spark, sf))
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in plan
    plan = plan_of(registry.knn_cosine(spark, sf))
    assert "label" not in plan


def test_neighbours_do_not_shuffle_the_corpus(spark, sf):
    """Between the index scan and the ranking there is no exchange; the idf weights come as a scalar subquery."""
    from passagework.operators.retrieval import retrieve

    plan = plan_of(retrieve(registry._questions(spark, sf), registry._index(spark, sf), 10))
    assert "hashpartitioning" not in plan[plan.index("MapInArrow") :]
    assert plan.count("WindowGroupLimit") == 2


def test_content_is_fetched_by_a_pushed_filter(spark, sf):
    plan = plan_of(registry.retrieve_passages(spark, sf))
    assert "In(chunk_id, [" in plan[plan.index("PushedFilters") :] and plan.count("BroadcastHashJoin") >= 1 and "MapInArrow" not in plan


def test_top_k_is_cut_before_the_shuffle(spark, sf):
    assert plan_of(registry.latest_per_key(spark, sf)).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan_of(registry.source_first_n(spark, sf))


def test_summary_stays_in_the_row(spark, sf):
    """Only the spreading of a small input shuffles; no text is sorted, joined or counted across rows."""
    plan = plan_of(registry.extractive_summary(spark, sf))
    assert plan.count("Exchange hashpartitioning") <= 1 and not any(x in plan for x in ("Window", "Join", "Aggregate"))


def test_scores_are_not_joined_to_their_own_inputs(spark, sf):
    assert plan_of(registry.score_compare(spark, sf)).count("Join") == 1


def test_stream_picks_up_only_new_files(spark, sf):
    root = scratch_path(spark, "test-stream")
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    batch = registry.html_chunks(spark, sf)

    def ingest():
        run = stream_page_chunks(
            spark, f"{root}/landing", pages.schema, f"{root}/out", f"{root}/state", ["page_id", "url"], **OPTIONS
        )
        run.awaitTermination()
        return spark.read.parquet(f"{root}/out")

    pages.where("page_id < 20").write.mode("append").parquet(f"{root}/landing")
    assert ingest().count() == batch.where("page_id < 20").count()
    pages.where("page_id >= 20").write.mode("append").parquet(f"{root}/landing")
    whole = ingest()
    assert whole.count() == batch.count() and whole.exceptAll(batch).isEmpty()
    assert ingest().count() == batch.count()


def test_stream_over_a_table_of_several_files(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/pages.parquet").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    found, wanted = registry.stream_ingest(spark, str(tmp_path)), registry.html_chunks(spark, sf)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.select(*found.columns).collect())) != []
