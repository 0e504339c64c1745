"""Chat formatting by event sourcing: a log of events per conversation is folded into messages and rendered.

Events have ``conv_id, seq, turn, kind, role, text``. ``message`` starts a turn, ``delta`` adds to it, ``edit`` replaces
its text, ``regenerate`` empties it (or starts it anew with the event's text) and voids what the log held of later
turns so far. Everything is built-in expressions: windows place events and texts, arrays hold one turn or one
rendered conversation.

Every turn is rendered as ``<s>[INST] role [/INST]text</s>``. The control strings ``<s> </s> [INST] [/INST]`` inside
roles and texts get a backslash after their first character, and those that already have backslashes there get one
more, so reading back is exact. The loss mask lists the code point spans of the assistant texts.

Nulls and odd input: null roles and texts are empty; events repeated exactly count once; events with equal
``seq`` in a turn go by kind, role and text; a turn's role is the last one named; a turn that has only deltas is their sum; null ``conv_id`` is a conversation;
rows without ``turn`` or ``seq`` come first. Other columns are ignored. An empty log gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.text import let, whole

OPEN, HEAD, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
_CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\])"
# "<INST]" and "[s>" are no control strings, but escaping them too keeps one pattern and stays reversible.
_ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?INST\])"
RESETS = ["message", "edit", "regenerate"]


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def fold(events: DataFrame) -> DataFrame:
    """The final messages: ``conv_id, turn, role, text``."""
    events = events.select(
        "conv_id", F.col("seq").cast("bigint").alias("seq"), F.col("turn").cast("bigint").alias("turn"), "kind",
        whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text"),
    ).distinct()
    earlier = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    voided = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    live = events.withColumn("voided", voided).where("voided is null or seq > voided")
    log = F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text")))
    turns = live.groupBy("conv_id", "turn").agg(log.alias("log"))
    named = F.filter(F.col("log.role"), lambda r: r != "")
    role = F.coalesce(F.get(named, F.size(named) - 1), F.lit(""))
    # the position of the last event that starts the text anew; what follows is appended
    last = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin(RESETS), i).otherwise(F.lit(0))))
    tail = let(last, lambda at: F.slice(F.col("log"), at + 1, F.size("log")))
    turns = turns.select("conv_id", "turn", role.alias("role"), tail.alias("log"))
    return turns.select("conv_id", "turn", "role", F.array_join("log.text", "").alias("text"))


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss``: the text of each conversation and the spans to learn from, ends excluded."""
    head = F.concat(F.lit(OPEN), escape(whole(F.col("role"))), F.lit(HEAD))
    parts = messages.select(
        "conv_id", "turn", "role", head.alias("head"), escape(whole(F.col("text"))).alias("body")
    ).withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.char_length("piece").cast("bigint")).over(order) - len(CLOSE)
    parts = parts.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("body"))
    piece = F.struct("start", "end", (F.col("role") == learn).alias("learn"), "piece")
    whole_ = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    spans = F.transform(F.filter("p", lambda x: x["learn"]), lambda x: F.struct(x["start"], x["end"]))
    return whole_.select("conv_id", F.array_join("p.piece", "").alias("formatted"), spans.alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id, turns, learned``: roles and texts parsed from the formatted text, and the text under the mask."""
    pieces = F.split("formatted", CLOSE, -1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, HEAD, 1)
        text = F.substr(piece, F.char_length(head) + len(HEAD) + 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"), unescape(text).alias("text")
        )

    learned = F.transform(
        "loss", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return rendered.select(
        "conv_id", "formatted",
        F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn).alias("turns"),
        F.array_join(learned, "").alias("learned"),
    )


def event_log(rows: DataFrame) -> DataFrame:
    """A log from finished rows: each is a turn of its own that opens with the first half of its text and streams the rest.

    Turns are numbered anew by turn, role and text; rows without a turn come last, as in the registered SQL.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), role, text)
    rows = rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("turn"), "role", text.alias("text"))
    half = (F.char_length("text") / 2).cast("int")
    first = F.struct(F.lit(0).alias("n"), F.lit("message").alias("kind"), F.substr("text", F.lit(1), half).alias("text"))
    rest = F.struct(F.lit(1).alias("n"), F.lit("delta").alias("kind"), F.substr("text", half + 1).alias("text"))
    log = rows.select("conv_id", "turn", "role", F.inline(F.array(first, rest)))
    return log.withColumn("seq", F.col("turn") * 2 + F.col("n")).drop("n")
