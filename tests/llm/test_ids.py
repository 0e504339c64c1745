"""Documents without an id, or with one that others have too: told apart by their texts, never lost, never mixed up."""

import math
from collections import Counter

import pytest

import corpus_pipeline
from passagework.llm import decontam, ngram_join, ngram_lm

DDL = "doc_id bigint, text string, lang string, source string, __spare string"
ITEM = "the quick brown fox jumps over the lazy dog near the old stone bridge every single morning"
CLEAN = [f"clean document number {i} speaks of {' '.join(f'thing{i}x{j}' for j in range(12))}" for i in range(6)]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("q1", ITEM), (None, CLEAN[0])], "item_id string, text string")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "extra") for i, t in rows], DDL)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_only_the_documents_that_hold_an_item_go(spark, benchmark):
    rows = [(None, CLEAN[0]), (None, f"so {ITEM} it says"), (7, CLEAN[1]), (7, ITEM), (7, ITEM), (8, CLEAN[2]), (None, None), (8, ""), (9, None)]
    found = decontam.decontaminate(frame(spark, rows), benchmark)
    assert found.columns == ["doc_id", "text", "lang", "source", "__spare"]
    assert kept(found) == sorted([r for r in rows if ITEM not in (r[1] or "")], key=str)
    matches = decontam.matches(frame(spark, rows), benchmark).collect()
    assert sorted((str(r.doc_id), r.item_id, r.start) for r in matches) == [("7", "q1", 0), ("None", "q1", 1)]


def test_one_of_each_group_by_smallest_id(spark):
    near = CLEAN[3].replace("thing3x11", "end")
    rows = [(None, CLEAN[0]), (None, CLEAN[1]), (7, CLEAN[2]), (7, CLEAN[3]), (5, near), (None, near), (7, CLEAN[2]), (6, None), (7, ""), (None, "")]
    found = kept(ngram_join.keep_one(frame(spark, rows), words=3, percent=60))
    assert found == sorted([(None, CLEAN[0]), (None, CLEAN[1]), (7, CLEAN[2]), (5, near), (6, None), (7, ""), (None, "")], key=str)


def test_ids_may_be_strings(spark):
    docs = spark.createDataFrame([("b", CLEAN[0]), ("a", CLEAN[0]), ("c", CLEAN[1])], "doc_id string, text string")
    assert kept(ngram_join.keep_one(docs)) == [("a", CLEAN[0]), ("c", CLEAN[1])]


def test_scores_of_rows_that_share_an_id(spark):
    """Twelve rows of one id score as they do under ids of their own; the id does not train, so the models are equal."""
    from zlib import crc32

    held = [i for i in range(1, 200) if crc32(str(i).encode()) % 7 == 2]
    train = [(i, " ".join(CLEAN[i % 6].split()[: 5 + i % 9])) for i in range(1000, 1060)]
    asked = [" ".join(CLEAN[i % 6].split()[i % 4 : 4 + i % 7]) for i in range(12)] + [None, ""]
    shared = frame(spark, [*train, *((held[0], t) for t in asked)])
    alone = frame(spark, [*train, *zip(held, asked)])
    by_text = lambda df, ids: Counter(
        (r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in ngram_lm.score_held_out(df).collect() if r.doc_id in ids
    )
    assert by_text(shared, {held[0]}) == by_text(alone, set(held))
    null = frame(spark, [*train, *((None, t) for t in asked)])
    assert by_text(null, {None}) == by_text(alone, set(held))
    assert all(math.isfinite(k[3]) for k in by_text(alone, set(held)))


def test_stages_take_an_empty_table(spark, sf):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, sf)
        assert out.count() == 0 and set(docs.columns) <= set(out.columns), name
