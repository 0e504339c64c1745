"""The numbered operators against brute-force versions, SQL and odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from passagework.llm import chat, components, decontam, gam, line_dedup, mixing, ngram_join, ngram_lm, quality_rules, repeats, toxicity
from passagework.llm.queries import ORACLE, QUERIES
from passagework.llm.text import word_count
from passagework.session import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id bigint, text string, lang string, source string, extra string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(6000))
SAME = "a line of forty characters or more, told by everyone"
ODD = [
    (1, None, None, None, "x"), (2, "", "en", "s", None), (3, "one", "en", "s", "y"), (4, LONG, "en", None, "y"), (5, LONG + " end", "de", "s", "y"),
    (6, " \t\n", "de", "t", "y"), (6, " \t\n", "de", "t", "y"), (None, "no id here", "en", "t", "y"),
    *((10 + i, f"{SAME}\nown words of number {i}", "en", "t", "z") for i in range(6)),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DDL)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def lower_words(text):
    return WORD.findall((text or "").translate(LOW))


def test_registered():
    found = entry_module.queries()
    assert set(QUERIES) <= set(found) and found["pipeline"] is corpus_pipeline.run
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf, duck, name):
    found, wanted = QUERIES[name](spark, sf).toPandas(), duck.execute(ORACLE[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    key = lambda df: sorted(map(str, df[columns].itertuples(index=False, name=None)))
    assert key(found) == key(wanted)


# --- 1: language model scores ------------------------------------------------------------------------


def brute_base(rows):
    each = [(i, [*lower_words(t), None]) for i, t in rows]
    counts = Counter(w for i, ws in each if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted((-1 if i is None else i, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in each)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_lm_base_is_exact(request, table):
    given = request.getfixturevalue(table)
    out = ngram_lm.score_held_out(given).toPandas()
    found = sorted((int(r.doc_id) if pd.notna(r.doc_id) else -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out.itertuples())
    assert found == brute_base(rows_of(given))
    assert (out["score"] <= 0).all() and np.isfinite(out["score"]).all()


def test_lm_base_is_exact_by_ranges(docs, odd, monkeypatch):
    whole = {table: ngram_lm.score_held_out(given).toPandas()["score"].sum() for table, given in (("odd", odd),)}
    monkeypatch.setattr(ngram_lm, "BITS", 6)
    for name, given in (("docs", docs), ("odd", odd)):
        out = ngram_lm.score_held_out(given).toPandas()
        found = sorted((int(r.doc_id) if pd.notna(r.doc_id) else -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out.itertuples())
        assert found == brute_base(rows_of(given))
        if name in whole:
            assert abs(out["score"].sum() - whole[name]) <= 0.02 * out["n_tokens"].sum()


def test_lm_levels_never_under_read(spark):
    model = ngram_lm.train(spark.createDataFrame([("a b a b a b c",)] * 5, "text string"), 4, 40)
    keys = ngram_lm.packed.word_hashes(__import__("pyarrow").array(["a b c zzz"]))
    hashes = next(keys)[1]
    assert (model.read(hashes, 1)[:3] >= ngram_lm.level(np.array([15, 15, 5]))).all()
    assert ngram_lm.lowest_levels(np.array([0, 10, 5]), np.array([0, 0, 100]), 40)[1] > 2


@pytest.mark.parametrize("bits", [16, 29])
def test_lm_holds_all_levels_at_every_size(spark, docs, monkeypatch, bits):
    monkeypatch.setattr(ngram_lm, "BITS", bits)
    held = stage(docs.where("doc_id is not null").select("doc_id", "text").limit(150), "held")
    texts = rows_of(held)
    _, hashes, counts = next(ngram_lm.packed.word_hashes(__import__("pyarrow").array([x for _, x in texts], "string")))
    texts = texts[: len(counts)]
    held = spark.createDataFrame(texts, "doc_id bigint, text string")
    keys, text = ngram_lm.tokens(hashes, counts)
    seen = Counter(keys.tolist()) + Counter(ngram_lm.pairs(keys, text)[0].tolist())
    model = ngram_lm.train(held, len(set(keys.tolist())), len(keys))
    levels = lambda k: ngram_lm.level(np.array([seen[x] for x in k.tolist()]))
    word, both = np.unique(keys), np.unique(ngram_lm.pairs(keys, text)[0])
    exact = np.bincount(text, ngram_lm.weigh(keys, text, levels(word), levels(both), model.tokens, model.distinct), len(texts))
    found = {r.doc_id: r.score for r in ngram_lm.score(held, model).collect()}
    assert (model.grams is None) == (bits == 29) and len(found) == len(texts)
    for (i, _), score, n in zip(texts, exact, counts + 1):
        assert abs(found[i] - score) <= 0.02 * n + 0.5


def test_lm_empty(empty):
    assert ngram_lm.score_held_out(empty).count() == 0


# --- 2: mixing ---------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    full, target = set(), {}
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        rest = [s for s in names if s not in full]
        target = {s: 3.0 * sizes[s] for s in full} | {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_mix_targets_and_words(request, table):
    given = request.getfixturevalue(table)
    sized = given.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    out = mixing.mix_sizes(sized).toPandas()
    again = mixing.mix_sizes(sized.repartition(5)).toPandas()
    key = lambda df: sorted(map(str, df.itertuples(index=False, name=None)))
    assert len(out) == given.count() and key(out) == key(again)
    out["source"] = out["source"].where(out["source"].notna(), None)
    sizes = {s if s is not None else None: int(g["size"].sum()) for s, g in out.groupby("source", dropna=False)}
    sizes = {None if s is None or s != s else s: n for s, n in sizes.items()}
    for s, t in brute_targets(sizes).items():
        own = out[out["source"].isna()] if s is None else out[out["source"] == s]
        assert own["target"].iloc[0] == pytest.approx(t, rel=1e-9)
        assert abs(own["taken"].sum() - t) <= own["size"].max() + 1
    assert (out["taken"] <= 3 * out["size"]).all()


def test_mix_table(odd, empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd).columns == [*odd.columns, "copy"]


# --- 3: line dedup -----------------------------------------------------------------------------------


def test_lines_odd(odd, empty):
    out = {(r.doc_id, r.text, r.n_dropped) for r in line_dedup.dedup_lines(odd).collect()}
    assert (15, f"{SAME}\nown words of number 5", 0) in out and (10, "own words of number 0", 1) in out
    assert (1, "", 0) in out and len(line_dedup.dedup_lines(odd).collect()) == len(ODD)
    assert line_dedup.dedup_lines(empty).count() == 0


# --- 4: n-gram join ----------------------------------------------------------------------------------


def brute_components(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = lower_words(t)
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    held = defaultdict(list)
    for i, s in sets.items():
        met = Counter(j for g in s for j in held[g])
        for j, both in met.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for g in s:
            held[g].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
@pytest.mark.parametrize("frequent", [1, 64])
def test_join_equals_brute_force(monkeypatch, docs, words, percent, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    out = ngram_join.near_copies(docs, words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(rows_of(docs), words, percent)


def test_join_with_common_copies(spark, monkeypatch):
    """Copies above the bound meet their representative by broadcast; the rows are those of the plain join, ids of null too."""
    text = "one two three four five six seven"
    rows = [(100 + i, text) for i in range(60)] + [(None, text), (None, "no id at all here"), (3, "alone with words of its own")]
    rows += [(200 + i, f"{i // 2} pairs of equal texts are few") for i in range(10)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = sorted(map(str, ngram_join.near_copies(given).collect()))
    monkeypatch.setattr(ngram_join, "COMMON", 20)
    spread = ngram_join.near_copies(given)
    assert sorted(map(str, spread.collect())) == plain and len(plain) == len(rows)
    assert {r.component_id for r in spread.collect() if (r.doc_id or 0) in range(100, 160)} == {100}
    counted = spark.createDataFrame([("a", 61), ("b", 21), ("c", 20), (None, 99)], "k string, count bigint")
    assert {r.k for r in ngram_join.common_keys(counted, "k", 73).collect()} == {"a", "b", None}
    left = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), ("d", 4), (None, 5)], "k string, v int")
    right = spark.createDataFrame([("a", "A"), ("c", "C")], "k string, w string")
    joined = ngram_join.join_common(left, right, "k", spark.createDataFrame([("a",), (None,)], "k string"))
    assert sorted((r.v, r.w) for r in joined.collect()) == [(1, "A"), (2, "A"), (3, "C"), (4, None), (5, None)]


def test_join_odd(odd, empty):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_copies(odd).collect()}
    assert out[1] == (0, 1) and out[6] == (0, 6) and out[None][1] is None
    assert out[5][1] == 4 and out[3] == (1, 3)
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {None, 1, 4} and 5 not in {r.doc_id for r in kept.collect()}
    assert ngram_join.near_copies(empty).count() == 0


def test_join_links_copies_of_frequent_shingles(spark):
    words = [f"v{i}" for i in range(54)]
    texts = [" ".join(words)] + [" ".join([*words[:at], f"new{at}x{k}", *words[at + 1 :]]) for k in range(2) for at in range(7, 47)]
    short = [f"s{i}" for i in range(12)]
    texts += [" ".join(w.upper() if k >> i & 1 else w for i, w in enumerate(short)) for k in range(80)]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_copies(given, 5, 80).collect()}
    assert out == brute_components(rows_of(given), 5, 80)
    assert len({c for _, c in out.values()}) == 2


def test_join_links_short_texts_of_frequent_shingles(spark):
    phrase = "all rights reserved worldwide by us and ours".split()
    texts = [" ".join([*phrase, *(f"own{i}x{j}" for j in range(40))]) for i in range(70)]
    for n in range(4, 9):
        texts += [" ".join(phrase[:n]), " ".join(phrase[:n]).upper(), "  ".join(phrase[:n]) + "\n"]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for words, percent in [(4, 85), (5, 80), (5, 75)]:
        out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_copies(given, words, percent).collect()}
        assert out == brute_components(rows_of(given), words, percent)


@pytest.mark.parametrize("percent", [50, 67, 70, 75, 80, 85, 90, 95, 100])
def test_join_signs_all_sets_of_frequent_shingles(percent, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 1)
    draw = np.random.default_rng(3)
    for n in range(1, 13):
        for _ in range(40):
            keys = np.sort(draw.integers(1, 2**63, n, np.uint64))
            both = keys[np.sort(draw.permutation(n)[: ngram_join.required(n, percent)])]
            sign = lambda k: {s for s, _ in ngram_join.signatures(k, np.full(len(k), 99.0), len(k), percent)}
            if 100 * len(both) >= percent * n:
                assert sign(keys) & sign(both)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 101)], "a bigint, b bigint")
    out = {(r.node, r.component) for r in components.components(edges).collect()}
    assert out == {(i, 1) for i in range(1, 41)} | {(100, 100), (101, 100)}


# --- 5: chat -----------------------------------------------------------------------------------------


def test_chat_events(spark):
    log = [
        (1, 0, 0, "message", "user", "h[INST]i"), (1, 1, 1, "message", "assistant", "ol"), (1, 2, 1, "delta", None, "d"),
        (1, 2, 1, "delta", None, "d"), (1, 3, 2, "message", "user", "gone"), (1, 4, 1, "regenerate", None, ""),
        (1, 5, 1, "delta", None, r"<\s>n"), (1, 6, 1, "delta", None, "ew"), (1, 7, 0, "edit", "user", "hello"), (2, 0, 0, "message", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id bigint, seq bigint, turn bigint, kind string, role string, text string")
    read = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(events))).collect()}
    assert [(t.role, t.text) for t in read[1].turns] == [("user", "hello"), ("assistant", r"<\s>new")]
    assert read[1].learned == r"<\s>new" and [tuple(t) for t in read[2].turns] == [("", "")]
    assert chat.read_back(chat.render(chat.fold(events.where("false")))).count() == 0


def test_chat_log_keeps_every_row(spark, tmp_path):
    import duckdb

    rows = [
        (1, None, "user", "null turn"), (1, 0, "user", "abcd"), (1, 0, "user", "efgh"), (1, 1, "assistant", "same"), (1, 1, "assistant", "same"),
        (2, None, "user", "first"), (2, None, "user", "second"), (3, 0, None, None), (3, 0, "user", "x"), (None, 0, "user", "no conversation"),
    ]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet' ORDER BY conv_id, turn, role NULLS FIRST, text")
    found = [tuple(r) for r in QUERIES["op5_chat"](spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(con.execute(ORACLE["op5_chat"]).fetchall(), key=str)
    read = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.event_log(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))))).collect()}
    assert [x.text for x in read[1].turns] == ["abcd", "efgh", "same", "same", "null turn"] and [x.text for x in read[2].turns] == ["first", "second"]


@pytest.mark.parametrize("text", ["</s>", r"<\s>", r"[\\INST] [/INST]", "<s", "a</s></s>b", "", "<<s>>", "[[INST]]", "<INST]"])
def test_escaping_is_reversible(spark, text):
    out = spark.createDataFrame([(text,)], "t string").select(chat.escape("t").alias("e"), chat.unescape(chat.escape("t")).alias("back")).first()
    assert out.back == text and not any(c in out.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


# --- 6: quality rules --------------------------------------------------------------------------------


def test_rule_counts(docs, odd):
    for given in (docs, odd):
        for r in quality_rules.metrics(given, ["doc_id", "text"]).collect():
            w, text = WORD.findall(r.text or ""), r.text or ""
            at = defaultdict(list)
            for i in range(len(w) - 4):
                at[tuple(w[i : i + 5])].append(i)
            covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(5)}
            lines = [x for x in text.split("\n") if WORD.search(x)]
            assert r.n_words == len(w) and r.word_chars == sum(map(len, w)) and r.n_repeat_words == len(covered)
            assert r.n_symbols == sum(c in "#*$%&|<>" for c in text) and r.n_dup_lines == len(lines) - len(set(lines))
            assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_binomial_tail_is_exact(spark):
    for n, k, rate in ((50, 0, 0.05), (400, 3, 0.02), (1000, 40, 0.05), (10, 3, 0.1)):
        wanted = 1.0 if k >= n * rate else sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), rate)).first()[0]
        assert got == pytest.approx(wanted, rel=1e-9)


def test_rules_keep_good_documents(spark):
    good = [(i, " ".join(f"word{j}{i}" for j in range(20)), "en") for i in range(3000)]
    bad = [(5000 + i, " ".join(f"w{j}{i}$$$$$$$$" for j in range(20)), "en") for i in range(50)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good] + [(i, 0) for i, _, _ in bad], "doc_id bigint, quality int")
    out = quality_rules.judge(docs, labels).toPandas()
    assert out[out["doc_id"] < 5000]["kept"].all() and not out[out["doc_id"] >= 5000]["kept"].any()
    assert quality_rules.judge(docs, labels.where("false")).toPandas()["kept"].all()


# --- 7 and 9: classifiers ----------------------------------------------------------------------------


@pytest.mark.parametrize("module, label, accuracy", [(toxicity, "toxic", 0.9), (gam, "quality", 0.97)])
def test_classifiers_on_held_out_rows(spark, module, label, accuracy):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = module.score(docs, module.train(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out[label]).mean() > accuracy and len(out) > 500
    assert (out["predicted"][out["toxic"] == 0] == 0).mean() > 0.98 if label == "toxic" else True


def test_toxic_recall_on_held_out_rows(spark):
    """Not all can be found: some toxic rows, 18 of 279 in English, hold none of the ten commonest insults."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    toxic = out["toxic"] == 1
    assert toxic.sum() > 90 and out["predicted"][toxic].mean() > 0.88 and out["predicted"][~toxic].mean() < 0.01


def test_toxicity_in_tasks_equals_the_local_model(spark):
    """Also with rows that repeat, and with a bound on the sample's characters."""
    rows = [(i, f"calm words of {i % 7}. nothing else here." if i % 3 else f"calm words. you are vile {i % 5}.") for i in range(300)]
    rows += [(1, None), (None, "no id"), rows[4]]
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), [(i, int(i % 3 == 0)) for i in range(300)]
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    used = [(t, dict(labels)[i]) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5]
    local, spread = toxicity.fit(*map(list, zip(*used))), toxicity.train(docs, known)
    assert spread.weights.keys() == local.weights.keys() and spread.bias == pytest.approx(local.bias)
    assert all(spread.weights[f] == pytest.approx(w, abs=1e-6) for f, w in local.weights.items())
    few = toxicity.training_rows(docs, known, "toxic", 5, 0, 1000, 500).toPandas()
    assert 0 < len(few) < len(used) and few["text"].fillna("").str.len().sum() <= 500
    assert toxicity.train(docs, known, chars=0).weights == {}


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (gam, "quality")])
def test_classifiers_odd(odd, empty, spark, module, label):
    none = spark.createDataFrame([], f"doc_id bigint, {label} int")
    some = spark.createDataFrame([(3, 1), (4, 0), (10, None), (None, 1)], f"doc_id bigint, {label} int")
    for labels in (none, some):
        out = module.score(odd, module.train(odd, labels)).toPandas()
        assert len(out) == len(ODD) and out["score"].between(0, 1).all()
    assert module.score(empty, module.train(empty, none)).count() == 0


def test_toxic_sentences_are_located(spark):
    texts = [f"calm words number {i}. nothing else here." for i in range(200)] + [f"calm words. you are vile and mean {i}." for i in range(40)]
    model = toxicity.fit(texts, [0] * 200 + [1] * 40)
    score, sentences = model.score("calm words here. you are vile and mean. fine.")
    assert score > 0.5 and [s[0] for s in sentences] == [1] and model.score(None)[0] == 0


# --- 8: decontamination ------------------------------------------------------------------------------


def brute_matches(docs, items, threshold=0.8):
    found = {}
    tokens = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for i, t in docs:
        w = tokens(t)
        for k, item in items:
            q = tokens(item)
            if not q:
                continue
            n = min(5, len(q))
            grams = lambda x: Counter(tuple(x[a : a + n]) for a in range(len(x) - n + 1))  # noqa: E731, B023
            want, own = grams(q), grams(w)
            if want & own:
                for s in range(1 - len(q), len(w)):
                    have = grams(w[max(0, s) : s + len(q)])
                    if have and sum((have & want).values()) / sum((have | want).values()) >= threshold:
                        found[i, k] = True
    return set(found)


def test_decontamination_equals_brute_force(spark, odd, empty):
    item = " ".join(f"item{i}" for i in range(24))
    other = "one two three"
    texts = [
        f"before {item} after", item, " ".join(item.split()[2:]), " ".join(item.split()[8:]), item.replace("item12", "changed"),
        f"x {other} y", None, "", item.upper() + ", end", f"{item} {item}",
    ]
    docs = list(enumerate(texts))
    items = [(1, item), (2, other), (3, None), (4, item)]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.matches(d, b).collect()} == brute_matches(docs, items)
    assert decontam.matches(empty, b).count() == 0 and decontam.matches(odd, b.where("false")).count() == 0
    assert decontam.decontaminate(odd, b).count() == len(ODD)


def test_decontamination_of_edited_items_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    items = [(k, fresh(int(rng.integers(12, 90)))) for k in range(30)]
    docs = []
    for i in range(600):
        w = list(items[i % 30][1])
        w = w[int(rng.integers(0, 4)) : len(w) - int(rng.integers(0, 4))]
        for _ in range(int(rng.integers(0, 3))):
            at = int(rng.integers(0, len(w)))
            w[at : at + int(rng.integers(0, 2))] = fresh(int(rng.integers(0, 6)))
        docs.append((i, " ".join(fresh(int(rng.integers(0, 30))) + w + fresh(int(rng.integers(0, 30))))))
    items = [(k, " ".join(q)) for k, q in items]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found, wanted = {(r.doc_id, r.item_id) for r in decontam.matches(d, b).collect()}, brute_matches(docs, items)
    assert len(wanted) > 150 and found == wanted


def test_blocks_find_all_within_the_radius(spark):
    rng = np.random.default_rng(5)
    a = int(rng.integers(-(2**63), 2**63))
    flips = [sum(1 << int(x) for x in rng.choice(64, decontam.RADIUS, replace=False)) for _ in range(50)]
    pairs = [(a, int(np.uint64(a % 2**64) ^ np.uint64(f)) - (2**64 if (a % 2**64) ^ f >= 2**63 else 0)) for f in flips]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert df.where(F.arrays_overlap(decontam.blocks(F.col("a")), decontam.blocks(F.col("b")))).count() == 50


# --- 10: suffix-array dedup --------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [3, 60_000])
def test_repeats_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = np.random.default_rng(3)
    fresh = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passage, line = fresh(260), fresh(199)
    texts = [fresh(300) + passage + fresh(50), passage, passage[20:240] + fresh(100), line + fresh(40), fresh(30) + line, "ab" * 300, None, "", fresh(500)]
    texts += [texts[8], fresh(5) + passage[:201], *(fresh(40) + passage + fresh(40) for _ in range(8))]
    docs = list(enumerate(texts)) + [(50, fresh(250))] * 2
    seen = Counter((t or "").encode()[k : k + 200] for _, t in docs for k in range(len((t or "").encode()) - 199))
    wanted = []
    for i, t in docs:
        b = (t or "").encode()
        change = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                change[k] += 1
                change[k + 200] -= 1
        gone = np.cumsum(change[:-1]) > 0
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        wanted.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    out = repeats.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out) == sorted(wanted)


def test_repeats_odd(odd, empty):
    assert repeats.remove_repeats(odd).count() == len(ODD) and repeats.remove_repeats(empty).count() == 0


class _Here:
    """A table of one batch whose scans run in this process."""

    def __init__(self, texts):
        self.batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])

    def select(self, *_):
        return self

    def mapInArrow(self, each, _):
        return [*each(iter([self.batch]))]


def _odd_texts():
    rng = np.random.default_rng(29)
    sizes = [0, 1, 149, 150, 151, 199, 200, 201, 0, 260, 3000, 30_000, 40_000, 5, *rng.integers(0, 900, 300).tolist()]
    return [*(bytes(rng.integers(97, 123, n).astype(np.uint8)).decode() for n in sizes), "a" * 700, "ab" * 300, "", None, "é" * 130]


def test_repeats_scan_takes_many_texts_at_once(monkeypatch):
    slides, slide = [], repeats._slide
    monkeypatch.setattr(repeats, "_slide", lambda *a: slides.append(1) or slide(*a))
    texts = _odd_texts()
    found = [h for batch in repeats._hashes(_Here(texts)) for hashes in batch.column(0).to_pylist() for h in hashes]
    assert 0 < len(slides) < 30  # two a text before, over 500
    alone = [np.frombuffer((t or "").encode(), np.uint8) for t in texts]
    assert found == [h for t in alone for h in repeats.cores(t, np.array([len(t)]))[1].view(np.int64).tolist()]


def test_repeats_cores_are_in_every_window_and_cross_no_text():
    texts = [(t or "").encode() for t in _odd_texts()]
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    places = np.sort(repeats.cores(data, ends)[0])
    for t, end in zip(texts, ends.tolist()):
        own = places[(places >= end - len(t)) & (places < end)] - (end - len(t))
        assert not len(own) or own.max() + repeats.CORE <= len(t)
        for k in range(len(t) - repeats.LENGTH + 1):
            assert ((own >= k) & (own <= k + repeats.SIDE)).any()


def test_repeats_names_and_sides_by_bytes():
    texts = [(t or "").encode() for t in _odd_texts()]
    edges = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    at, _ = repeats.cores(data, edges[1:])
    of = np.searchsorted(edges, at, "right") - 1
    names, there = repeats.strings_at(data.tobytes(), at, edges[of], edges[of + 1])
    sides, strings = repeats.sides_at(data, at, there), {}
    for name, (left, right), side, a, k in zip(names, there.tolist(), sides, (at - edges[of]).tolist(), of.tolist()):
        assert (left, right) == (min(a, 50), min(len(texts[k]) - a - 150, 50))
        before, core, after = texts[k][a - left : a], texts[k][a : a + 150], texts[k][a + 150 : a + 150 + right]
        assert side.tobytes() == before.rjust(50, b"\0") + after.ljust(50, b"\0")
        assert strings.setdefault((before, core, after), name.tobytes()) == name.tobytes()
    assert len(set(strings.values())) == len(strings) < len(at)


def test_repeats_cut_of_a_batch(monkeypatch):
    monkeypatch.setattr(repeats, "CUT_BYTES", 2000)
    monkeypatch.setattr(repeats, "GIVEN_ROWS", 3)
    rng, rows = np.random.default_rng(31), []
    for t in _odd_texts():
        raw = np.frombuffer((t or "").encode(), np.uint8)
        marks, gone = [], np.zeros(len(raw), bool)
        for _ in range(int(rng.integers(1, 4)) if len(raw) >= 250 else 0):
            left = [int(x) for x in rng.choice(51, 2, replace=False)]
            at = [int(x) for x in rng.integers(50, len(raw) - 199, 4)]
            for place in at:
                for a in left:
                    gone[place - a : place - a + 200] = True
            marks.append({"at": at, "mask": sum(1 << a for a in left)})
        wanted = (int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), raw[~gone].tobytes())
        rows.append((t if marks else None, marks or None, wanted if marks else (0, 0, None)))
    text, marks, wanted = zip(*rows)
    at, mask = ([[m[k] for m in x] if x else None for x in marks] for k in ("at", "mask"))
    for part in (slice(0, None), slice(3, 200), slice(0, 0)):  # a slice's offsets do not begin at 0
        own = [pa.array(c, k)[part] for c, k in ((text, pa.string()), (at, pa.list_(pa.list_(pa.int32()))), (mask, pa.list_(pa.int64())))]
        assert [tuple(r.values()) for r in repeats._cut.func(*own).to_pylist()] == [*wanted[part]]


# --- pipeline ----------------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf, docs):
    before = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stage(step(spark, before, sf), "test")
        assert after.columns == docs.columns and 0 < after.count() <= before.count(), name
        if name == "ngram_join":
            found = brute_components(rows_of(before), 5, 80)
            assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in found.items() if i == c}
        before = after
    mixed = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert mixed.columns == [*docs.columns, "copy"] and mixed.count() > 0


def test_pipeline_on_odd_rows(spark, odd, sf):
    given = odd.withColumn("n_chars", F.lit(0).cast("bigint"))
    for _, step in corpus_pipeline.STAGES:
        given = corpus_pipeline.stage(step(spark, given, sf), "odd")
    assert given.count() > 0
