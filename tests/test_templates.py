"""Templates: one pass, checked placeholders; contexts, examples, reports and names."""

import pytest
from pyspark.sql import functions as F

from passagework.functions import templates as P
from passagework.plans import prompts
from passagework.functions import text as X
from passagework.operators import context as K


def rendered(spark, template, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in values))
    return df.select(P.render(template, {n: F.col(n) for n in values})).first()[0]


def test_values_are_never_templates(spark):
    out = rendered(spark, "C:{context} Q:{question}", context="{question} {x} {{y}}", question="{context}")
    assert out == "C:{question} {x} {{y}} Q:{context}"


def test_braces_repeats_and_nulls(spark):
    assert rendered(spark, "{{a}} {a}{a}", a="v") == "{a} vv"
    assert rendered(spark, "{a}", a=None) is None
    assert spark.range(1).select(P.render("plain", {})).first()[0] == "plain"


@pytest.mark.parametrize(
    "template,values,declared",
    [
        ("{a} {b}", {"a"}, None),
        ("{a}", {"a", "b"}, None),
        ("{a}", {"a"}, ["a", "b"]),
        ("{a", {"a"}, None),
        ("a}", set(), None),
        ("{1}", {"1"}, None),
    ],
)
def test_bad_templates(template, values, declared):
    with pytest.raises(ValueError):
        P.render(template, {v: F.lit("x") for v in values}, declared)


def test_default_wordings():
    assert P.placeholders(prompts.FROM_PASSAGES) == ["context", "question"]
    assert P.placeholders(prompts.RATE_TONE_LIKE) == ["examples", "input_string"]
    assert P.placeholders(prompts.HELP_DESK) == ["question"]
    for template in (prompts.RATE_TONE, prompts.SHOW_WORK, prompts.SURE_ONLY):
        assert P.placeholders(template) == ["input_string"]


def test_examples_keep_their_order(spark):
    rows = [(3, "c", "Neutral"), (1, "a {x}", "Negative"), (2, "b", "Positive"), (4, "d", "Positive")]
    pool = spark.createDataFrame(rows, "id int, t string, l string").repartition(4)
    block = K.example_block(pool, ["id"], 3, "t", "l")
    out = spark.range(1).select(P.render("{examples}|{q}", {"examples": block, "q": F.lit("?")})).first()[0]
    assert out == "- Negative: a {x}\n- Positive: b\n- Neutral: c|?"


def test_stuffing_follows_ranks(spark):
    rows = [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 1, "x")]
    hits = spark.createDataFrame(rows, "qid int, rk int, content string").repartition(4)
    assert {r.qid: (r.context, r.n_docs) for r in K.stuff(hits, "qid").collect()} == {
        1: ("a\n\nb\n\nc", 3),
        2: ("x", 1),
    }


def test_documents(spark):
    df = spark.createDataFrame([("u", "c", 1)], "url string, content string, n int")
    row = K.as_documents(df, "content").first()
    assert row.page_content == "c" and row.metadata.asDict() == {"url": "u", "n": 1}


def test_report_escapes_everything(spark):
    df = spark.createDataFrame(
        [("<q>", "a & \"b\" 'c' <script>", [(2, "two", "u2"), (1, "o&ne", 'u"1')])],
        "q string, a string, refs array<struct<rk:int,content:string,source:string>>",
    )
    out = df.select(K.report(F.col("q"), F.col("a"), F.array_sort("refs"))).first()[0]
    assert out == (
        "<section><h3>Question</h3><p>&lt;q&gt;</p><h3>Answer</h3>"
        "<p>a &amp; &quot;b&quot; &#39;c&#39; &lt;script&gt;</p><h3>References</h3><ol>"
        '<li>o&amp;ne <a href="u&quot;1">u&quot;1</a></li><li>two <a href="u2">u2</a></li></ol></section>'
    )


def test_namespace_part(spark):
    for address, part in (("ann.lee@x.org", "ann"), ("bob@x.org", "bob"), ("carl", "carl"), (None, None)):
        df = spark.createDataFrame([(address,)], "a string")
        assert df.select(X.namespace_part(F.col("a"))).first()[0] == part
