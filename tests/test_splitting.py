"""The recursive splitter against a plain string version of its specification, and its invariants."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passagework.functions.splitting import split_spans
from passagework.operators import chunking as C

TOKEN = re.compile(r"[^\W_]+")
SEPARATORS = ["\n\n", "\n", " ", ""]


def count(text):
    return len(TOKEN.findall(text))


def by_specification(text, size, overlap, separators=SEPARATORS):
    """String form: first separator present, kept at the front; small pieces packed, large ones cut further."""
    at = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    separator, finer = separators[at], separators[at + 1 :]
    if separator == "":
        pieces = list(text)
    else:
        parts = text.split(separator)
        pieces = [p for p in [parts[0]] + [separator + p for p in parts[1:]] if p]
    chunks, run = [], []

    def pack():
        window, total = [], 0
        for piece in run:
            n = count(piece)
            if window and total + n > size:
                chunks.append("".join(window).strip())
                while total > overlap or (total > 0 and total + n > size):
                    total -= count(window.pop(0))
            window.append(piece)
            total += n
        if window:
            chunks.append("".join(window).strip())
        run.clear()

    for piece in pieces:
        if count(piece) < size:
            run.append(piece)
        else:
            pack()
            chunks.extend(by_specification(piece, size, overlap, finer) if finer else [piece.strip()])
    pack()
    return [c for c in chunks if c]


words = st.text(alphabet="ab1.-é\n ", min_size=0, max_size=300)


@settings(max_examples=300, deadline=None)
@given(words, st.integers(2, 9), st.integers(0, 4))
def test_equals_specification(text, size, overlap):
    overlap = min(overlap, size - 1)
    assert [c for c, _ in split_spans(text, size, overlap)] == by_specification(text, size, overlap)


@settings(max_examples=200, deadline=None)
@given(words)
def test_invariants(text):
    chunks = split_spans(text, 5, 2)
    assert all(n <= 5 for _, n in chunks)
    assert all(c == c.strip() and c for c, _ in chunks)
    # Only the cut between characters may break a token.
    if any(s in text for s in " \n") and all(count(w) < 5 for w in text.replace("\n", " ").split(" ")):
        assert all(count(c) == n for c, n in chunks)
        seen = {t for c, _ in chunks for t in TOKEN.findall(c)}
        assert seen == set(TOKEN.findall(text))


def test_edges():
    assert split_spans("") == []
    assert split_spans(" \n\n \n") == []
    line = " ".join(f"w{i}" for i in range(401))
    chunks = split_spans(line)
    assert [n for _, n in chunks] == [400, 51]
    assert chunks[1][0].split()[:50] == chunks[0][0].split()[-50:]
    word = "x" * 5000
    # Without any blank the only separator left is between characters, each letter counting as one.
    assert [c for c, _ in split_spans(word)] == [word[a : a + 400] for a in range(0, 4901, 350)]
    assert [c for c, _ in split_spans(word + " y")] == [word + " y"]
    dashed = "-".join("x" * 5000)
    assert all(n <= 400 for _, n in split_spans(dashed))


def test_caller_counter_and_separators():
    chunks = split_spans("aa bb cc", 2, 0, ("\n", " ", ""), len)
    assert all(n <= 2 for _, n in chunks) and "".join(c for c, _ in chunks) == "aabbcc"


def test_pass_through_equals_the_splitter(spark):
    """Texts the JVM keeps to itself are those the splitter would leave whole."""
    texts = ["x" * 5000, "x" * 400, "x" * 401, "x" * 5000 + " y", " ".join("abcd" * 100), "a-" * 399, " ", "a\n" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = C.explode_chunks(df.select("id", C.whole_text(F.col("t")).alias("w")), C.split_long(F.col("w")), ["id"])
    found = {}
    for row in rows.orderBy("id", "chunk_pos").collect():
        found.setdefault(row.id, []).append(row.content)
    assert found == {i: w for i, t in enumerate(texts) if (w := by_specification(t.strip(), 400, 50))}


def test_whole_documents_in_spark(spark, sf):
    from passagework.plans.registry import recursive_split

    found = {}
    for row in recursive_split(spark, sf).orderBy("doc_id", "chunk_pos").collect():
        found.setdefault(row.doc_id, []).append(row.content)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    wanted = {k: by_specification(t, 400, 50) for k, t in texts.items()}
    assert found == {k: v for k, v in wanted.items() if v}
    assert max(len(v) for v in wanted.values()) > 2


def test_complete_chunker_in_spark(spark, sf):
    """html_chunks_split from its own sections: merge, split and filter done by hand."""
    from passagework.plans.registry import header_sections, html_chunks_split

    sections = {}
    for row in header_sections(spark, sf).orderBy("page_id", "pos").collect():
        sections.setdefault(row.page_id, []).append(row.text)
    wanted = {}
    for page, texts in sections.items():
        # each text starts a new group unless the group with it stays within half the limit
        groups: list[list[str]] = []
        for text in texts:
            joined = bool(groups) and count("\n".join([*groups[-1], text])) <= 200
            groups[-1:] = [[*groups[-1], text]] if joined else [*groups[-1:], [text]]
        merged = ["\n".join(g) for g in groups]
        chunks = [c for m in merged for c in by_specification(m.strip(), 400, 50)]
        wanted[page] = [c for c in chunks if count(c) > 20]
    found = {}
    for row in html_chunks_split(spark, sf).orderBy("page_id", "chunk_pos").collect():
        found.setdefault(row.page_id, []).append(row.content)
        assert row.n_tokens == count(row.content) <= 400
    assert found == {k: v for k, v in wanted.items() if v}
    assert html_chunks_split(spark, sf).groupBy("page_id").count().agg(F.max("count")).first()[0] > 1
