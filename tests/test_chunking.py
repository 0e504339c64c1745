"""Greedy merge, minimum length and token windows at their boundaries."""

import pytest
from pyspark.sql import functions as F

from passagework.functions import text as X
from passagework.operators import chunking as C


def words(n, prefix="w"):
    return " ".join(f"{prefix}{i}" for i in range(n))


def merged(spark, sections, max_tokens=400):
    df = spark.createDataFrame([(sections,)], "s array<string>")
    out = df.select(C.merge_sections(F.col("s"), max_tokens)).first()[0]
    return None if out is None else [(r.content, r.n_tokens) for r in out]


@pytest.mark.parametrize(
    "sizes,wanted",
    [
        ([200], [200]),
        ([201], [201]),
        ([100, 100], [200]),
        ([100, 101], [100, 101]),
        ([201, 1], [201, 1]),
        ([1, 250, 1, 1], [1, 250, 2]),
        ([], []),
    ],
)
def test_merge_boundaries(spark, sizes, wanted):
    assert [n for _, n in merged(spark, [words(n) for n in sizes])] == wanted


def test_merge_text(spark):
    assert merged(spark, ["\na b", "", "c"], 400) == [("a b\n\nc", 3)]
    assert merged(spark, ["a", None, "b"], 2) == [("a", 1), ("b", 1)]
    assert merged(spark, ["", " "], 400) == []
    assert merged(spark, None) is None


def test_minimum_is_strict(spark):
    df = spark.createDataFrame([(1, words(20)), (2, words(21)), (3, None), (4, "")], "id int, t string")
    assert [r.id for r in C.chunk_text(df, "t", ["id"]).collect()] == [2]


def test_caller_tokenizer(spark):
    df = spark.createDataFrame([(["aaa", "bbb", "c" * 12],), (None,)], "s array<string>")
    chunks = C.split_with_tokenizer(F.col("s"), lambda: len, max_tokens=14, overlap=0, min_tokens=3)
    rows = [r[0] for r in df.select(chunks).collect()]
    assert [(c.content, c.n_tokens) for c in rows[0]] == [("aaa\nbbb", 7), ("c" * 12, 12)]
    assert rows[1] is None


def test_windows(spark):
    def windows(n):
        df = spark.createDataFrame([(words(n),)], "t string")
        return df.select(X.token_windows(F.col("t"), 4, 1)).first()[0]

    assert windows(0) == []
    assert windows(4) == ["w0 w1 w2 w3"]
    assert windows(5) == ["w0 w1 w2 w3", "w3 w4"]
    assert windows(7) == ["w0 w1 w2 w3", "w3 w4 w5 w6"]
    with pytest.raises(ValueError):
        X.token_windows(F.lit("a"), 4, 4)


def test_cuts_keep_the_text(spark):
    text = " «One», TWO!  three\n(four) -- Five. "
    df = spark.createDataFrame([(text,), ("...",), ("",), (None,)], "t string")
    cut = lambda n: [r[0] for r in df.select(X.truncate_tokens(F.col("t"), n)).collect()]
    assert cut(2) == [" «One», TWO", "...", "", None]
    assert cut(5) == [text, "...", "", None]
    windows = [r[0] for r in df.select(X.token_windows(F.col("t"), 3, 1)).collect()]
    assert windows == [["One», TWO!  three", "three\n(four) -- Five"], [], [], None]


def test_token_patterns_agree(spark):
    """The JVM's letters and digits and Python's, over every assigned character both know."""
    import unicodedata

    import regex

    from passagework.functions.splitting import _TOKEN

    chars = [chr(c) for c in range(1, 0x3000) if unicodedata.category(chr(c)) != "Cn"]
    plain = regex.compile(r"[\p{L}\p{N}]")
    assert [c for c in chars if bool(_TOKEN.fullmatch(c)) != bool(plain.fullmatch(c))] == []
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    known = df.where(~F.col("c").rlike(r"\p{Cn}")).withColumn("n", X.token_count(F.col("c")))
    # Characters the JVM's older Unicode version does not know are left out.
    assert [r.c for r in known.collect() if r.n != bool(_TOKEN.fullmatch(r.c))] == []
    assert known.count() > 10000
