"""XML, sitemap, payload and bounded sources; names, views and tables."""

import pytest
from pyspark.sql import functions as F

from passagework import catalog
from passagework.session import CHECKPOINT_KEY, scratch_path, scratch_root
from passagework.sources import tables as S
from passagework.sources import xml as XM

POSTS = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" Score="5" Body="&lt;p&gt;a &amp;amp; b&lt;/p&gt;" />
  <row Id="x2" Title="no score" />
  <row Id="3" Score="many" Body="" />
</posts>
"""
SITEMAP = """<?xml version="1.0" encoding="UTF-8"?>
<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
<url><loc>https://b.example/2?x=1&amp;y=2</loc><lastmod>2020-01-01</lastmod></url>
<url><loc>
  https://a.example/1
</loc></url>
<url><lastmod>2020-01-01</lastmod></url>
</urlset>
"""


@pytest.fixture
def posts(tmp_path):
    (tmp_path / "posts.xml").write_text(POSTS)
    return str(tmp_path / "posts.xml")


@pytest.fixture
def sitemap(tmp_path):
    (tmp_path / "sitemap.xml").write_text(SITEMAP)
    return str(tmp_path / "sitemap.xml")


@pytest.mark.parametrize("by_line", [False, True])
@pytest.mark.parametrize("columns", [None, ["Id", "Score", "Title", "Body"]])
def test_attribute_rows(spark, posts, by_line, columns):
    df = XM.read_xml_rows(spark, posts, columns=columns, by_line=by_line)
    assert sorted(df.columns) == ["Body", "Id", "Score", "Title"]
    assert {t for _, t in df.dtypes} == {"string"}
    rows = {r.Id: (r.Score, r.Title, r.Body) for r in df.collect()}
    assert rows == {"1": ("5", None, "<p>a &amp; b</p>"), "x2": (None, "no score", None), "3": ("many", None, "")}
    typed = df.select(F.col("Id").try_cast("bigint").alias("id"), F.col("Score").try_cast("int").alias("score"))
    assert sorted(typed.collect(), key=str) == [(1, 5), (3, None), (None, None)]


@pytest.mark.parametrize("columns", [None, ["Id", "Score"]])
def test_a_bad_element(spark, tmp_path, columns):
    lines = ["<posts>", '<row Id="1" Score="2" />', '<row Id="9" Score=5 />', '<row Id="3" Score="4" />', "</posts>"]
    (tmp_path / "bad.xml").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "bad.xml")
    rows = XM.read_xml_rows(spark, path, columns=columns, by_line=True)
    assert sorted(map(tuple, rows.collect()), key=str) == [("1", "2"), ("3", "4"), (None, None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        XM.read_xml_rows(spark, path, columns=columns).collect()


@pytest.mark.parametrize("columns", [None, ["Id", "Score", "Title", "Body"]])
def test_splits_read_what_the_whole_file_reader_reads(spark, posts, columns):
    whole, split = XM.read_xml_rows(spark, posts, columns=columns), XM.read_xml_splits(spark, posts, columns=columns)
    assert sorted(split.columns) == sorted(whole.columns)
    assert sorted(map(str, split.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    """Elements of any form and length, wherever a split ends; tags with longer names are none."""
    texts = ["a &lt;row b", "x" * 900, "", "&#10;line &quot;q&quot;", "it's > 1", "é𝄞 &amp;amp;"]
    rows = [f"""<row Id="{i}"\n Body = "{texts[i % 6]}" Other='{i % 3}"'{"/>" if i % 2 else ">text<b/></row>"}""" for i in range(3000)]
    (tmp_path / "big.xml").write_text("<?xml version='1.0'?>\n<rows>" + "\n<rowing Id='no'/>".join(rows) + "</rows>\n", encoding="utf-8")
    path, key = str(tmp_path / "big.xml"), "spark.sql.files.maxPartitionBytes"
    wanted = sorted(map(str, XM.read_xml_rows(spark, path).collect()))
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        found = XM.read_xml_splits(spark, path)
        parts = found.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 8 and sorted(map(str, found.collect())) == wanted and len(wanted) == 3000
    finally:
        spark.conf.set(key, before)


def test_a_bad_element_fails_the_split_reader(spark, tmp_path):
    (tmp_path / "bad.xml").write_text('<posts>\n<row Id="1" Score="2" />\n<row Id="9" Score=5 />\n</posts>')
    for columns in (None, ["Id"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            XM.read_xml_splits(spark, str(tmp_path / "bad.xml"), columns=columns).collect()


def test_sitemap(spark, sitemap):
    assert sorted(r.url for r in XM.read_sitemap(spark, sitemap).collect()) == [
        "https://a.example/1",
        "https://b.example/2?x=1&y=2",
    ]


def test_dataset_kinds_respect_the_limit(spark, sf, posts, sitemap):
    assert [r.url for r in S.load_dataset(spark, "sitemap", sitemap, 1).collect()] == ["https://a.example/1"]
    assert [r.Id for r in S.load_dataset(spark, "posts", posts, 2).collect()] == ["x2", "1"]
    pages = f"{sf}/pages.parquet"
    assert S.load_dataset(spark, "pages", pages, 7).count() == 7
    assert S.load_dataset(spark, "pages", pages).count() == 50
    with pytest.raises(ValueError):
        S.load_dataset(spark, "other", pages)


def test_first_n_and_split(spark):
    df = spark.createDataFrame([(3, "train"), (1, "train"), (2, "test")], "id int, split string")
    assert [r.id for r in S.pick_split(df, "train", 1, "id").collect()] == [1]
    assert S.first_n(df, None).count() == 3
    with pytest.raises(ValueError):
        S.first_n(df, 2)


def test_payload(spark):
    landing = spark.createDataFrame(
        [("a", bytearray("é".encode()), 200), ("b", bytearray(b"gone"), 404), ("c", None, 200)],
        "url string, html binary, status int",
    )
    urls = S.from_values(spark, ["a", "b", "c", "d", "a"])
    rows = S.attach_payload(urls, landing, status="status").collect()
    assert sorted((r.url, r.html) for r in rows if r.html) == [("a", "é"), ("a", "é")]
    assert sorted(r.url for r in rows if r.html is None) == ["b", "c", "d"]


def test_a_hot_address_keeps_every_row(spark):
    """A third of the addresses are one, a third are null; each keeps its row."""
    urls = spark.range(3000).selectExpr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN concat('u', id) END AS url")
    landing = spark.createDataFrame([("hot", "h"), ("u1", "x"), (None, "never")], "url string, html string")
    rows = S.attach_payload(urls, landing).groupBy("html").count().collect()
    assert {r.html: r["count"] for r in rows} == {"h": 1000, "x": 1, None: 1999}


def test_payloads_stay_in_their_buckets(spark, monkeypatch, tmp_path):
    """No exchange of payloads beside a bucketed landing table, and a hot address's copies are made by many tasks."""
    monkeypatch.setattr(S, "COPIES", 100)
    landing = spark.createDataFrame([(f"u{i}", f"payload {i}") for i in range(50)], "url string, html string")
    table = catalog.overwrite_table(landing, "passagework_test_landing", str(tmp_path / "landing"), bucket_by="url", buckets=4)
    urls = spark.range(4000).selectExpr("CASE WHEN id % 4 < 3 THEN 'u7' WHEN id % 8 = 3 THEN concat('u', id % 90) END AS url")
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        rows = S.attach_payload(urls, table, buckets=4)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan" in line]
        assert scans and all("Bucketed: true" in line for line in scans)
        for before in plan.split("FileScan")[:-1]:  # the scan's last steps up to its join
            assert "Exchange" not in before[before.rindex("+- Sort") :]
        found = {(r.url, r.html): r["count"] for r in rows.groupBy("url", "html").count().collect()}
        wanted = {(r.url, r.html): r["count"] for r in urls.join(landing, "url", "left").groupBy("url", "html").count().collect()}
        assert found == wanted and found["u7", "payload 7"] >= 3000
        tasks = rows.where("url = 'u7'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1
    finally:
        for name in small:
            spark.conf.unset(name)
        catalog.drop_table(spark, "passagework_test_landing")


def test_namespace_and_tables(spark, tmp_path):
    assert catalog.current_namespace(spark, "ns_").startswith("ns_")
    name = "passagework_test"
    catalog.ensure_schema(spark, name)
    catalog.ensure_schema(spark, name)
    table = f"{name}.chunks"
    first = spark.range(5).withColumn("t", F.lit("x"))
    assert catalog.overwrite_table(first, table, str(tmp_path / "chunks")).count() == 5
    again = catalog.overwrite_table(first.limit(3), table, str(tmp_path / "chunks"), bucket_by="id", buckets=4)
    assert again.count() == 3
    plan = again.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    catalog.publish_view(again, "passagework_view")
    assert spark.table("passagework_view").count() == 3
    catalog.drop_table(spark, table)
    catalog.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_scratch_folder_is_the_sessions(spark):
    if spark.conf.get(CHECKPOINT_KEY, None):
        assert scratch_root(spark) == spark.conf.get(CHECKPOINT_KEY).rstrip("/")
    assert scratch_root(spark) == scratch_root(spark)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
