"""Quality rules whose cutoffs are chosen under a risk bound.

Counts per document are built-in expressions over the whole text. A fixed floor rejects texts that are too short or too
repetitive. Beyond it, each rule compares one share with a cutoff. For every stratum, rule and cutoff of a fixed grid
the labelled good documents that it would reject are counted, and the cutoff is safe if so few rejections would be
unlikely, by the exact binomial distribution, were the true rate above the rule's part of ``risk``. ``confidence`` holds
for all strata, rules and cutoffs together (Bonferroni), so the strictest safe cutoff may be taken. A stratum with too
few labels has no safe cutoff and its rules reject nothing.

Nulls and odd input: a null text has no words and fails the floor; a null stratum is a stratum; labels other than 1 and
null labels are not used; repeated rows are kept, and count as often as they occur. A document without words has shares
of 0. An empty table gives an empty result, and without labels only the floor applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.llm.text import BLANKS, join_same, let, lines, whole, words
from passagework.operators.rows import compute_once
from passagework.session import stage

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_BROADCAST_STRATA = 10_000
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def share(part: str, of: str) -> Column:
    return F.when(F.col(of) > 0, F.col(part) / F.col(of)).otherwise(F.lit(0.0))


def rules() -> dict[str, tuple[Column, list[float]]]:
    """The share each rule looks at, rejecting what lies above its cutoff; grids go from lenient to strict."""
    return {
        "symbols": (share("n_symbols", "word_chars"), [0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.075, 0.05]),
        "repeats": (share("n_repeat_words", "n_words"), [0.2, 0.175, 0.15, 0.125, 0.1, 0.075, 0.05]),
        "dup_lines": (share("n_dup_lines", "n_words"), [0.5, 0.2, 0.1, 0.05, 0.02]),
        "long_words": (share("word_chars", "n_words"), [40.0, 30.0, 20.0, 15.0, 12.0, 10.0]),
        "short_words": (-share("word_chars", "n_words"), [-1.0, -1.5, -2.0, -2.5, -3.0]),
    }


def repeat_words(w: Column, window: int = WINDOW) -> Column:
    """Words of ``w`` in runs of ``window`` words that occur twice or more in it."""
    hashes = F.when(
        F.size(w) >= window,
        F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(window)))),
    )

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        met = let(
            placed,
            lambda p: F.transform(
                F.filter(
                    F.transform(
                        p,
                        lambda x, k: F.struct(
                            x["i"].alias("i"),
                            F.coalesce(
                                (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]),
                                x["h"] == F.get(p, k - 1)["h"],
                                x["h"] == F.get(p, k + 1)["h"],
                                F.lit(False),
                            ).alias("met"),
                        ),
                    ),
                    lambda x: x["met"],
                ),
                lambda x: x["i"],
            ),
        )
        return let(
            F.sort_array(met),
            lambda at: F.aggregate(
                F.transform(at, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - x, F.lit(window)))),
                F.lit(0), lambda a, x: a + x,
            ),
        )

    return let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))
    ).cast("bigint")


def metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the counts of each text."""
    text = whole(F.col("text"))
    split = compute_once(docs, [*keep, "text"], __w=words(F.col("text")))
    with_word = F.filter(lines(F.col("text")), lambda x: F.char_length(F.btrim(x, F.lit(BLANKS))) > 0)
    length = lambda without: F.char_length(F.translate(text, without, ""))
    return split.select(
        *keep,
        F.size("__w").cast("bigint").alias("n_words"),
        length(BLANKS).cast("bigint").alias("word_chars"),
        (F.char_length(text) - length(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("__w")).alias("n_repeat_words"),
        F.size("__w").between(0, MIN_WORDS - 1).alias("__short"),
    ).withColumn(
        "base_failed", F.col("__short") | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    ).drop("__short")


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """The exact probability of at most ``k`` of ``n`` at ``rate``; 1 where ``k`` is not below ``n * rate``."""
    odds = F.lit(rate / (1 - rate))
    start = F.struct((n * F.log(F.lit(1 - rate))).alias("term"), F.exp(n * F.log(F.lit(1 - rate))).alias("sum"))

    def add(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i * odds)
        return F.struct(term.alias("term"), (s["sum"] + F.exp(term)).alias("sum"))

    upto = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.aggregate(upto, start, add)["sum"])


def safe_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float, confidence: float) -> DataFrame:
    """``stratum, rule, cutoff``: the strictest safe cutoff, for the strata and rules that have one."""
    good = labels.where("quality = 1").select("doc_id", "quality").distinct()
    held = measured.where(~F.col("base_failed")).join(good, "doc_id")
    grid = [(rule, c, value > c) for rule, (value, cuts) in rules().items() for c in cuts]
    counts = held.groupBy(stratum).agg(
        F.count("*").alias("n"), *(F.sum(hit.cast("bigint")).alias(f"k{i}") for i, (_, _, hit) in enumerate(grid))
    )
    counts = stage(counts, "rule-counts")
    tests = max(1, counts.count()) * len(grid)
    each = F.array(
        *(F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"k{i}").alias("k")) for i, (r, c, _) in enumerate(grid))
    )
    tried = counts.select(stratum, "n", F.inline(each))
    tail = binomial_tail(F.col("n"), F.col("k"), risk / len(rules()))
    safe = tried.where(tail <= (1 - confidence) / tests)
    return safe.groupBy(stratum, "rule").agg(F.min("cutoff").alias("cutoff"), F.max("n").alias("n_labelled"))


def judge(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, confidence: float = 0.95
) -> DataFrame:
    """``doc_id``, the stratum, the counts, ``base_failed``, ``rejected_by`` and ``kept``."""
    measured = stage(metrics(docs, ["doc_id", stratum]), "rule-metrics")
    cutoffs = safe_cutoffs(measured, labels, stratum, risk, confidence)
    cutoffs = stage(cutoffs.groupBy(stratum).agg(F.collect_list(F.struct("rule", "cutoff")).alias("__cuts")), "rule-cutoffs")
    if cutoffs.count() <= MAX_BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    met = join_same(measured, cutoffs, [stratum], "left")
    values = F.create_map(*(x for rule, (value, _) in rules().items() for x in (F.lit(rule), value)))
    hit = F.filter(F.coalesce("__cuts", F.array().cast("array<struct<rule:string,cutoff:double>>")), lambda c: F.element_at(values, c["rule"]) > c["cutoff"])
    rejected = F.array_sort(F.transform(hit, lambda c: c["rule"]))
    return met.withColumn("rejected_by", rejected).select(
        "doc_id", stratum, *METRICS, "base_failed", "rejected_by",
        (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"),
    )
