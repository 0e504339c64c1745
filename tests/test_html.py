"""Extraction, clean-up and sections on hand-written pages with values worked out by hand."""

from pyspark.sql import functions as F

from passagework.functions import html as H
from passagework.functions.container import outer_container
from passagework.plans.ingest import extract_articles, page_chunks

NESTED = (
    '<body><div class="x">noise</div>'
    '<div itemprop="articleBody"> <div>one <div>two</div></div><script>var a="</div></div>";</script> &amp; three</div>'
    '<div itemprop="articleBody">second</div></body>'
)
NESTED_BODY = (
    '<div itemprop="articleBody"> <div>one <div>two</div></div><script>var a="</div></div>";</script> &amp; three</div>'
)


def one(spark, value, *exprs):
    return spark.createDataFrame([(value,)], "v string").select(*exprs).first()[0]


def articles(spark, pages, selector, **options):
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    return {r.id: r.article for r in extract_articles(df, ["id"], selector=selector, **options).collect()}


def test_nested_container(spark):
    assert articles(spark, [NESTED], H.ARTICLE_BODY) == {0: NESTED_BODY}
    # The plain expression stops at the first close tag: that is why such pages go to the parser.
    assert articles(spark, [NESTED], H.ARTICLE_BODY, native=True)[0] != NESTED_BODY


def test_no_container_is_left_out(spark):
    pages = ["<p>none</p>", None, "", "<div>x</div>", '<div itemprop="other">x</div>', '<div itemprop="ARTICLEBODY">x</div>']
    assert articles(spark, pages, H.ARTICLE_BODY) == {}
    assert articles(spark, pages, H.ARTICLE) == {}


def test_hidden_containers_do_not_count(spark):
    pages = [
        "<!-- <article>old</article> --><p>x</p>",
        "<script>'<article>'</script><article>real</article>",
        "<article>a<script>'</article>'</script>b</article>",
        "<ARTICLE class=y>upper</ARTICLE>",
        "<article>outer<article>inner</article>tail</article>",
    ]
    assert articles(spark, pages, H.ARTICLE) == {
        1: "<article>real</article>",
        2: "<article>a<script>'</article>'</script>b</article>",
        3: "<ARTICLE class=y>upper</ARTICLE>",
        4: "<article>outer<article>inner</article>tail</article>",
    }


def test_attributes_with_brackets(spark):
    page = '<div data-x="a>b" itemprop="articleBody">text</div>'
    assert articles(spark, [page, '<div data-x="a>b">text</div>'], H.ARTICLE_BODY) == {0: page}
    page = "<article title='a>b'>text</article>"
    assert articles(spark, [page], H.ARTICLE) == {0: page}


def test_container_helper_closes_what_was_left_open():
    assert outer_container("<p><div a='1'>x<b>y</div>z", "div", "a", "1") == "<div a='1'>x<b>y</div>"
    assert outer_container("<section><div>x</section>z", "div") == "<div>x</div>"
    assert outer_container("<div>x<br>y", "div") == "<div>x<br>y</div>"
    assert outer_container("x</div><div/>y<div>z</div>", "div") == "<div/>"
    assert outer_container("<p>x</p>", "div") is None


def test_clean_text(spark):
    html = "<p>A <b>b</b>old</p><style>p{}</style><!-- c --><p>two<br>lines &lt;i&gt; &amp;lt; &#233;&#xe9; &nope; &copy</p>"
    assert one(spark, html, H.clean_text(F.col("v"))) == "A bold\ntwo\nlines <i> &lt; éé &nope; ©"
    assert one(spark, None, H.clean_text(F.col("v"))) is None
    assert one(spark, "2 < 3 and 4 > 1", H.clean_text(F.col("v"))) == "2 < 3 and 4 > 1"


def test_entities(spark):
    text = "&#128512; &#0; &#xD800; &#1114112; &hellip; & &; &amp;amp; &apos;"
    assert one(spark, text, H.decode_entities(F.col("v"))) == "😀 � � � … & &; &amp; '"


def test_entities_equal_the_standard_library(spark):
    """All names of HTML 5, old ones without a semicolon and inside longer words, and Windows-1252 numbers."""
    import html
    from html.entities import html5

    texts = [f"a &{n} b" for n in html5] + [f"&{n}x1;" for n in html5 if not n.endswith(";")]
    texts += [f"&#{n}; &#x{n:X} z" for n in [*range(128, 160), 65, 233, 8364, 128512]] + ["&notit; &notin; &ampamp; &AMP &amplt;", "&#150 &#x96 &#00150;"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    found = {r.i: r.t for r in df.select("i", H.decode_entities(F.col("v")).alias("t")).collect()}
    assert {texts[i]: t for i, t in found.items()} == {t: html.unescape(t) for t in texts}


def test_sections(spark):
    html = "<div>lead<h2>One</h2><p>first</p><h2 id='x'>Two <i>b</i></h2><h2>Three</h2>last<script>'<h2>'</script></div>"
    rows = one(spark, html, H.sections(F.col("v")))
    assert [(r.header, r.content) for r in rows] == [("", "lead"), ("One", "first"), ("Two b", ""), ("Three", "last")]
    assert one(spark, "<h2></h2>", H.sections(F.col("v"))) == []
    assert one(spark, None, H.sections(F.col("v"))) is None
    text = H.section_text(F.lit(None).cast("string"), F.lit("c"))
    assert one(spark, "", text) == "\nc"


def test_pages_to_chunks(spark):
    words = " ".join(f"w{i}" for i in range(30))
    page = f"<article><h2>Head</h2><p>{words}</p></article>"
    df = spark.createDataFrame([("a", page), ("b", "<p>no article</p>"), ("c", None)], "url string, html string")
    rows = page_chunks(df, ["url"]).collect()
    assert [(r.url, r.chunk_pos, r.content, r.n_tokens) for r in rows] == [("a", 0, f"Head\n{words}", 31)]
