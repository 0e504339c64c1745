"""Whitening, token counts and hard negatives against brute-force versions and odd input."""

import functools
import math
import os

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passagework.llm import hard_negatives, token_counts, whitening
from passagework.llm.queries import op11_whitening, op12_token_counts
from passagework.session import scratch_path

DDL = "vec_id bigint, embedding array<float>, label int, row int, x string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], DDL)


@pytest.fixture(scope="module")
def vectors(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


# --- 11: whitening -----------------------------------------------------------------------------------


def brute_whitening(rows):
    """All in numpy on the driver: rows as {id: [x]}, distinct vectors, eigenvectors of the covariance."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in usable]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:16]
    out = []
    for i, x in xs:
        d = [n * a - s for a, s in zip(x, sums)]
        w = np.array([v / n for v in d]) @ directions[:, order] / np.sqrt(values[order])
        out += [(i, k + 1, n, sum(v * v for v in d), w[k], values[order[k]] / values.sum()) for k in range(len(order))]
    return out


def same_whitening(found, wanted):
    """Equal up to one sign for each component."""
    found, wanted = sorted(found), sorted(wanted)
    assert [f[:4] for f in found] == [w[:4] for w in wanted]
    for k in {w[1] for w in wanted}:
        f, w = (np.array([r[4] for r in x if r[1] == k]) for x in (found, wanted))
        assert min(np.abs(f - w).max(), np.abs(f + w).max()) < 1e-6
    assert max(abs(f[5] / w[5] - 1) for f, w in zip(found, wanted)) < 1e-9


def test_whitening_equals_eigenvectors(spark, sf, vectors):
    found = [tuple(r) for r in op11_whitening(spark, sf).collect()]
    assert max(r[6] for r in found) < 1e-9
    same_whitening([r[:6] for r in found], brute_whitening([(r.vec_id, r.embedding) for r in vectors.collect()]))


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in v], 0) for i, v in enumerate(rng.normal(size=(60, 5)))]
    odd = [(100, None, 0), (101, [1.0, None, 1.0, 1.0, 1.0], 0), (102, [float("nan")] * 5, 0), (103, [float("inf")] + [0.0] * 4, 0)]
    copies = [(7, good[7][1], 1), (None, good[3][1], 1), *((200 + i, good[0][1], 1) for i in range(40))]
    short = [(104, [1.0, 2.0], 0), (105, [], 0)]
    found = whitening.whitened_vectors(table(spark, good + odd + copies + short)).collect()
    wanted = brute_whitening([(-1 if i is None else i, np.float32(v).tolist()) for i, v, _ in good + copies])
    same_whitening([(-1 if r[0] is None else r[0], *r[1:6]) for r in found], wanted)
    assert max(r.identity_error for r in found) < 1e-9


def test_whitening_leaves_out_directions_without_variance(spark):
    rng = np.random.default_rng(4)
    free = rng.normal(size=(80, 3))
    rows = [(i, [*map(float, v), 2.5, math.floor(64 * np.float32(v[0])) / 64], 0) for i, v in enumerate(free)]
    found = whitening.whitened_vectors(table(spark, rows)).toPandas()
    assert sorted(set(found["component"])) == [1, 2, 3] and found["identity_error"].max() < 1e-6


def test_whitening_of_badly_conditioned_rows(spark):
    """Deviations from 1 to a million: the squared condition is beyond double precision."""
    rng = np.random.default_rng(5)
    scale = np.array([1e6, 1e3, 1.0, 0.05])
    turn, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    rows = [(i, [float(c) for c in (v * scale) @ turn], 0) for i, v in enumerate(rng.normal(size=(300, 4)))]
    found = whitening.whitened_vectors(table(spark, rows)).toPandas()
    assert sorted(set(found["component"])) == [1, 2, 3, 4] and found["identity_error"].max() < 1e-4


def test_whitening_of_nothing(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, [], 0)]):  # no variance in any
        out = whitening.whitened_vectors(table(spark, rows))
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_exact_beyond_64_bits():
    model = whitening.Whitening(1 << 41, [5, 7], 1 << 40, np.eye(2), np.ones(2), np.ones(2))
    x = np.array([[1 << 39, -(1 << 39)]], np.int64)
    assert model.deviation(x).tolist() == [((1 << 80) - 5) ** 2 + ((1 << 80) + 7) ** 2]


# --- 12: token counts --------------------------------------------------------------------------------


def tokenizer(name="byte_bpe_50k.json"):
    return token_counts.Tokenizer.of(public_tokenizers.path(name))


@functools.cache
def counter_of(name):
    return token_counts.counter(tokenizer(name))


@functools.cache
def plain_of(name):
    return tokenizer(name).load()


def plain_counts(texts, name="byte_bpe_50k.json"):
    return plain_of(name)(texts)


def test_counts_equal_the_library(spark, sf):
    found = {r.doc_id: r for r in op12_token_counts(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    wanted = plain_counts([r.text or "" for r in rows])
    assert len(found) == len(rows)
    for r, n in zip(rows, wanted):
        assert tuple(found[r.doc_id]) == (r.doc_id, len((r.text or "").encode()), n, n > 512)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from([" ", "  ", "\n", "'s", "<|endoftext|>", "é", "1 2", "\x1c", "​", " ", "́", "Ж ж", "中 文"])), max_size=12))
def test_pieces_add_up(parts):
    text = "".join(parts)
    texts = [text, text + " x", "a " + text]
    assert counter_of("byte_bpe_50k.json")(texts) == plain_counts(texts)


def test_only_missing_texts_are_encoded(spark, monkeypatch):
    cache = scratch_path(spark, "cache")
    ddl = "doc_id bigint, text string, content string, n_tokens int"
    first = [(1, "one two", "x", 0), (2, None, "x", 0), (2, "", None, 0), (None, "one two", "x", 0), (3, "w " * 5000, "x", 0)]
    more = [*first, (4, "three <|endoftext|> four", "x", 0), (4, "five", "x", 0)]
    seen = []
    plain = token_counts.encode
    monkeypatch.setattr(token_counts, "encode", lambda texts, t: plain(seen.append(sorted(r.text for r in texts.collect())) or texts, t))
    for rows in (first, more, more, []):
        found = token_counts.count_tokens(spark.createDataFrame(rows, ddl), tokenizer(), cache).collect()
        texts = [r[1] or "" for r in rows]
        wanted = [(r[0], len(t.encode()), n, n > 512) for r, t, n in zip(rows, texts, plain_counts(texts) if texts else [])]
        assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert seen == [["", "one two", "w " * 5000], ["five", "three <|endoftext|> four"]]
    # another tokenizer finds nothing of the first one's
    other = token_counts.count_tokens(spark.createDataFrame(first, ddl), tokenizer("piece_bpe_32k.model"), cache).collect()
    assert len(seen) == 3 and sorted(r.n_tokens for r in other) == sorted(plain_counts([r[1] or "" for r in first], "piece_bpe_32k.model"))


@pytest.mark.parametrize("few, hot", [(0, 2), (10, 2)])
def test_hot_contents_and_many_missing(spark, monkeypatch, few, hot):
    monkeypatch.setattr(token_counts, "FEW", few)
    monkeypatch.setattr(token_counts, "HOT", hot)
    cache = scratch_path(spark, "cache")
    rows = [(i, f"text {i % 7 if i < 30 else 'of all'}") for i in range(60)]
    for given_rows in (rows[:10], rows):
        df = spark.createDataFrame(given_rows, "doc_id bigint, text string")
        found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, tokenizer(), cache).collect()}
        assert found == dict(zip([i for i, _ in given_rows], plain_counts([t for _, t in given_rows])))


def test_library_by_name():
    with pytest.raises(ValueError):
        token_counts.Tokenizer.of(os.devnull)
    assert not tokenizer("word_bpe_49k.json").separable() and tokenizer().separable()
    texts = ["Hello  World", "", "a<|endoftext|>b"]
    assert token_counts.counter(tokenizer("word_bpe_49k.json"))(texts) == plain_counts(texts, "word_bpe_49k.json")


# --- 13: hard negatives ------------------------------------------------------------------------------


def brute_negatives(rows):
    """Rows as (id, vector, label), labels moved already."""
    usable = [(i, [math.floor(256 * float(c)) for c in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, (anchor, x, label) in enumerate(usable):
        if anchor % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, v)), i, b, y) for b, (i, v, y) in enumerate(usable) if b != a]
        scored.sort()
        for s, p, _, _ in [r for r in scored if r[3] == label][:5]:
            hits = [(n, t) for t, n, _, y in scored if y != label and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(anchor, p, k + 1, n, -s, -t) for k, (n, t) in enumerate(hits)]
    return sorted(out)


def mined(df):
    return hard_negatives.mine(df, F.col("id") % 100 == 0, F.col("vec_id"), F.col("label"))


def found_negatives(df):
    out = mined(df)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("least", [2048, 8])
def test_negatives_with_ties_and_odd_rows(spark, monkeypatch, least):
    """Few different vectors, so most scores tie; a third of the rows are one vector; ids repeat; many tiles and parts."""
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", least)
    monkeypatch.setattr(hard_negatives, "BLOCK_SCORES", 64)
    rng = np.random.default_rng(6)
    kinds = [[float(c) for c in v] for v in rng.integers(-2, 3, size=(9, 6)) / 8]
    rows = [(i, kinds[0 if i % 3 == 0 else i % 9], i % 4) for i in range(420)]
    rows += [(100, kinds[2], 1), (100, kinds[2], 1), (7, kinds[1], 2), (200, kinds[3], None), (None, kinds[3], 1), (300, None, 1)]
    rows += [(500, [float("nan")] * 6, 1), (600, [None] * 6, 1), (700, [1.0], 1), (800, [0.0] * 6, 1), (900, kinds[4], 99)]
    wanted = brute_negatives([r for r in rows if r[1] is None or len(r[1]) == 6])
    assert found_negatives(table(spark, rows)) == wanted and len(wanted) > 200


def test_negatives_of_nothing(spark):
    assert found_negatives(table(spark, [])) == []
    assert found_negatives(table(spark, [(0, [1.0, 0.0], 1)])) == []
    assert found_negatives(table(spark, [(0, None, 1), (100, [], 1)])) == []
    with pytest.raises(Exception, match="too large"):
        mined(table(spark, [(0, [1e9, 0.0], 1)])).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 70), st.integers(1, 40), st.integers(0, 70), st.integers(0, 2**31))
def test_strassen_is_exact(m, k, n, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(1 << 28), 1 << 28, (m, k)), rng.integers(-(1 << 28), 1 << 28, (k, n))
    assert (hard_negatives.strassen(a, b) == (a.astype(object) @ b.astype(object))).all()


def test_heaps_merge_like_one_sort():
    rng = np.random.default_rng(8)
    heaps, every = hard_negatives.Heaps(3, 4), []
    for part in range(6):
        scores, ids = rng.integers(0, 4, (3, 9)), np.arange(9) + 9 * part
        allowed = rng.random((3, 9)) < 0.6
        every += [(o, -s, i) for o in range(3) for s, i, ok in zip(scores[o], ids, allowed[o]) if ok]
        heaps.offer(scores, allowed, ids, ids)
    frame = pd.DataFrame(sorted(every), columns=["o", "s", "i"]).groupby("o").head(4)
    assert list(zip(heaps.owner, -heaps.score, heaps.id)) == list(frame.itertuples(index=False, name=None))
