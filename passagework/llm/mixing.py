"""Mixing sources to target weights by pivotal dependent rounding.

Every document starts with the fractional number of copies its source needs. The whole part is certain; the
fractions are paired, and words move at random from one to the other until one of the two is settled at 0 or 1.
The unsettled one meets the next. This happens inside small groups; what each group leaves unsettled, one
document at most, climbs a reduction tree whose groups hold ``FAN`` entries. A source's words stay on target
through every transfer and only the last open document of a source is drawn alone.

The expectation of every document's copies is its source's rate, and documents go in falling size, so the one left
over is small. Draws are hashes of a seed and the two documents: reruns and retried tasks agree.

Nulls and odd input: a null text has size 0; a null source is a source of its own, ordered last; a null ``doc_id`` is
an id. Documents without words are taken at their source's whole copies and add none. Rows that repeat the same id,
source and size are one unit and share one decision. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.text import chance, join_same, let, word_count
from passagework.session import stage

WEIGHTS = (1.0, 2.0, 3.0)
LIMIT = 3.0
FAN = 512
UNIT = ["source", "doc_id", "size"]


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """Words each source shall give: its weight's share of all words, at most ``limit`` times its own size.

    What a full source cannot take is shared anew by weight until none is above its limit. With sources ordered by
    the level at which they fill up, the final level is the largest of the levels reached after each of them. The
    windows here see one row a source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    full = F.lit(limit) * F.col("source_size")
    ranked = sources.withColumn("weight", weight).withColumn("fill", full / F.col("weight"))
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(full).over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.withColumn("level", (F.sum("source_size").over(everything) - before) / left)
    ranked = ranked.withColumn("level", F.max("level").over(everything))
    return ranked.select("source", "source_size", F.least(full, F.col("level") * F.col("weight")).alias("target"))


def _meet(state: Column, other: Column, seed: int) -> Column:
    """One transfer between the open document and the next: one of them is settled, the other stays open."""
    a, b = state["open"], other
    room = let(
        F.struct(
            F.least((1 - a["p"]) * a["mass"], b["p"] * b["mass"]).alias("up"),
            F.least(a["p"] * a["mass"], (1 - b["p"]) * b["mass"]).alias("down"),
            chance(F.lit(seed), a["doc_id"], a["size"], b["doc_id"], b["size"]).alias("u"),
        ),
        lambda r: F.struct(
            (r["u"] * (r["up"] + r["down"]) < r["down"]).alias("rises"),
            F.when(r["u"] * (r["up"] + r["down"]) < r["down"], r["up"]).otherwise(-r["down"]).alias("moved"),
        ),
    )

    def settle(r: Column) -> Column:
        first = F.when(r["rises"], (1 - a["p"]) * a["mass"] <= b["p"] * b["mass"]).otherwise(
            a["p"] * a["mass"] <= (1 - b["p"]) * b["mass"]
        )

        def after(x: Column, sign: int) -> Column:
            p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x["p"] + sign * r["moved"] / x["mass"]))
            return F.struct(x["mass"].alias("mass"), x["doc_id"].alias("doc_id"), x["size"].alias("size"), p.alias("p"))

        def done(x: Column, up: Column) -> Column:
            return F.array(F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), up.alias("up")))

        return F.struct(
            F.when(first, after(b, -1)).otherwise(after(a, 1)).alias("open"),
            F.concat(
                state["done"], F.when(first, done(a, r["rises"])).otherwise(done(b, ~r["rises"]))
            ).alias("done"),
        )

    return let(room, settle)


def _fold(units: Column, seed: int, id_type: str) -> Column:
    empty = F.array().cast(f"array<struct<doc_id:{id_type},size:bigint,up:boolean>>")
    start = F.struct(units[0].alias("open"), empty.alias("done"))
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, lambda s, x: _meet(s, x, seed))


def round_copies(sized: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """``source, doc_id, size, copies`` for every distinct unit of ``sized``."""
    id_type = dict(sized.dtypes)["doc_id"]
    units = sized.groupBy(*UNIT).agg(F.count("*").alias("n"))
    units = join_same(units, targets, ["source"], "inner")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.withColumn("rate", rate).withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
    units = units.withColumn("mass", (F.col("size") * F.col("n")).cast("double"))
    units = stage(units.select(*UNIT, "mass", "whole", "p"), "mix-units")

    fractional = units.where("p > 0 and mass > 0")
    counts = fractional.groupBy("source").agg(F.ceil(F.count("*") / FAN).alias("groups"))
    groups = counts.agg(F.max("groups")).first()[0] or 0
    spread = join_same(fractional, counts, ["source"], "inner")
    spread = spread.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), "groups"))
    open_, settled = spread.select("source", "bucket", F.struct("mass", "doc_id", "size", "p").alias("x")), []
    while groups:
        folded = open_.groupBy("source", "bucket").agg(F.sort_array(F.collect_list("x"), asc=False).alias("xs"))
        folded = stage(folded.select("source", "bucket", _fold(F.col("xs"), seed, id_type).alias("s")), "mix-level")
        settled.append(folded.select("source", F.inline("s.done")))
        open_ = folded.select("source", F.floor(F.col("bucket") / FAN).alias("bucket"), F.col("s.open").alias("x"))
        groups = math.ceil(groups / FAN) if groups > 1 else 0
    last = open_.select("source", "x.doc_id", "x.size", (chance(F.lit(seed), "x.doc_id", "x.size") < F.col("x.p")).alias("up"))
    for part in settled:
        last = last.unionByName(part)
    joined = join_same(units, last, UNIT, "left")
    copies = F.col("whole") + F.coalesce(F.col("up").cast("bigint"), F.lit(0))
    return joined.select(*UNIT, copies.alias("copies"))


def mix_sizes(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT, seed: int = 17) -> DataFrame:
    """``doc_id, source, size`` with ``source_size``, ``target``, ``copies`` and ``taken`` words."""
    sized = stage(sized.select("doc_id", "source", F.col("size").cast("bigint").alias("size")), "mix-sizes")
    targets = stage(source_targets(sized, weights, limit), "mix-targets")
    copies = round_copies(sized, targets, seed)
    out = join_same(join_same(sized, copies, UNIT, "inner"), targets, ["source"], "inner")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT, seed: int = 17) -> DataFrame:
    """The mixed table: each document as often as it was drawn, with its number ``copy``."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    taken = mix_sizes(sized, weights, limit, seed).where("copies > 0").select(*UNIT, "copies").distinct()
    taken = taken.withColumnsRenamed({"size": "__size", "copies": "__copies"})
    met = join_same(
        docs.withColumn("__words", word_count(F.col("text"))),
        taken.withColumnRenamed("__size", "__words"),
        ["source", "doc_id", "__words"],
        "inner",
    )
    numbered = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return numbered.select(*(F.col(f"`{c}`") for c in docs.columns if c != "copy"), "copy")
