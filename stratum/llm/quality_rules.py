"""Quality rules whose cutoffs are chosen with a bound on the share of good documents they reject."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import SPACE_CHARS, salted_join, shingle_hashes, stored, words

SYMBOLS = "#*$%&|<>"

#: Rules and their ladders of cutoffs, from lenient to strict: a document above a rule's cutoff is rejected.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "shouts_per_word": (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "repeated_words": (0.18, 0.15, 0.12, 0.1),
    "repeated_lines": (0.9, 0.75, 0.6, 0.5, 0.4, 0.3),
}

#: Share of a stratum's good documents that all rules together may reject, and the probability that this fails.
MAX_FALSE_REJECTION, RISK = 0.02, 0.1

#: Up to so many strata the cutoffs are broadcast.
_BROADCAST_STRATA = 10_000


def _occurrences(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(tokens: Column, hashes: Column) -> Column:
    """Words covered by windows whose hash occurs more than once in the text."""
    n = F.size(hashes)
    sorted_windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(windows: Column) -> Column:
        same = lambda x, j: F.coalesce(x["h"] == F.get(windows, j - 1)["h"], F.lit(False)) | F.coalesce(
            x["h"] == F.get(windows, j + 1)["h"], F.lit(False)
        )
        return F.sort_array(F.transform(F.filter(windows, same), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(5)), F.lit(5)))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    # Nested one-element transforms bind a value once.
    one = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    found = one(sorted_windows, lambda w: one(starts(w), covered))
    return F.when((F.size(tokens) < 5) | (F.size(F.array_distinct(hashes)) == n), 0).otherwise(found)


def measured(rows: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_m``: the measures of a text.  Null has no words, symbols or lines."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    step = rows.withColumns({"_words": words(t), "_lines": lines}).withColumn("_runs", shingle_hashes(F.col("_words"), 5))
    measures = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(t, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        _occurrences(t, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words"), F.col("_runs")).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        _occurrences(t, "!").cast("long").alias("n_shouts"),
    )
    return step.withColumn("_m", measures).drop("_words", "_lines", "_runs")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def scores(m: Column) -> dict[str, Column]:
    per = lambda part, whole: part / F.greatest(whole, F.lit(1))
    return {
        "symbols_per_word": per(m["n_symbols"], m["n_words"]),
        "shouts_per_word": per(m["n_shouts"], m["n_words"]),
        "repeated_words": per(m["n_repeat_words"], m["n_words"]),
        "repeated_lines": per(m["n_dup_lines"], m["n_lines"]),
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p); 1 beyond the mean, where no test can pass."""
    first = F.struct((n * math.log1p(-p)).cast("double").alias("term"), F.lit(0.0).alias("sum"))

    def add(state: Column, j: Column) -> Column:
        following = state["term"] + F.log((n - j) / (j + 1)) + math.log(p / (1 - p))
        return F.struct(following.alias("term"), (state["sum"] + F.exp(state["term"])).alias("sum"))

    summed = F.aggregate(F.sequence(F.lit(0).cast("long"), k), first, add, lambda s: F.least(s["sum"], F.lit(1.0)))
    return F.when(k > n * p, 1.0).otherwise(summed)


def calibrate(
    good: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, risk: float = RISK
) -> DataFrame:
    """One row per stratum with a ``cutoffs`` struct of one value per rule (infinite: no cutoff is safe).

    ``good``: ``stratum`` and ``_m`` of the holdout's good documents; those that the base rejects are lost anyway and
    take no part.  A setting is safe if so few rejections would have a probability of at most its share of the risk were
    the true rate among such documents of the stratum above the allowed one (exact binomial test).
    Two families of settings have half of the risk each.  In the first every rule has its own ladder and an equal
    share of the allowed false rejection and of the risk.  In the second all rules go up their ladders together, and
    the documents that any of them rejects are tested against the whole of it, which needs a quarter of the documents.
    Tests of a ladder run from lenient to strict and stop at the first that fails, which needs no further correction.
    The second counts where the first has no cutoff.  The risk is divided by the number of strata that are tested
    (Bonferroni): those with documents enough to pass if none were rejected and no other stratum were tested, which the
    outcomes do not influence.  The others have no row.
    """
    value = scores(F.col("_m"))
    steps = max(len(ladder) for ladder in RULES.values())
    at = lambda ladder, i: ladder[min(i, len(ladder) - 1)]
    any_above = [reduce(or_, [value[r] > at(ladder, i) for r, ladder in RULES.items()]) for i in range(steps)]
    own = good.where(~base_failed(F.col("_m"))).groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.count_if(value[r] > c).alias(f"{r}_{i}") for r, ladder in RULES.items() for i, c in enumerate(ladder)],
        *[F.count_if(above).alias(f"any_{i}") for i, above in enumerate(any_above)],
    )
    testable = binomial_tail(F.lit(0).cast("long"), F.col("n"), max_false_rejection) <= risk / 2
    counted = stored(own.where(testable), "rule-counts")
    limit = risk / (2 * max(counted.count(), 1))
    tails = counted.select(
        "stratum",
        *[
            binomial_tail(F.col(f"{r}_{i}"), F.col("n"), max_false_rejection / len(RULES)).alias(f"_p_{r}_{i}")
            for r, x in RULES.items() for i in range(len(x))
        ],
        *[binomial_tail(F.col(f"any_{i}"), F.col("n"), max_false_rejection).alias(f"_p_any_{i}") for i in range(steps)],
    )

    def climbed(name: str, ladder: Sequence[float], most: float) -> Column:
        cutoff, safe = F.lit(float("inf")), F.lit(True)
        for i, c in enumerate(ladder):
            safe = safe & (F.col(f"_p_{name}_{i}") <= most)
            cutoff = F.when(safe, c).otherwise(cutoff)
        return cutoff

    alone = {r: climbed(r, ladder, limit / len(RULES)) for r, ladder in RULES.items()}
    joint = {r: climbed("any", [at(ladder, i) for i in range(steps)], limit) for r, ladder in RULES.items()}
    none = reduce(and_, [x == float("inf") for x in alone.values()])
    chosen = [F.when(none, joint[r]).otherwise(alone[r]).alias(r) for r in RULES]
    return stored(tails.select("stratum", F.struct(*chosen).alias("cutoffs")), "rule-cutoffs")


def judged(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to rows with ``stratum`` and ``_m``.

    A stratum without a row in ``cutoffs``, too small for a test or without labels, loses only what the base rejects: no
    cutoff is tested on the documents of others.
    """
    few = cutoffs.count() <= _BROADCAST_STRATA
    joined = rows.join(F.broadcast(cutoffs), "stratum", "left") if few else salted_join(rows, cutoffs, ["stratum"], "left")
    m = F.col("_m")
    above = F.lit(False)
    for rule, score in scores(m).items():
        above = above | F.coalesce(score > F.col(f"cutoffs.{rule}"), F.lit(False))
    return joined.withColumns({"base_failed": base_failed(m), "kept": ~base_failed(m) & ~above}).drop("cutoffs")


def _stratum() -> Column:
    return F.coalesce(F.concat(F.lit("lang "), F.col("lang")), F.lit("none")).alias("stratum")


def _cutoffs(measures: DataFrame, labels: DataFrame) -> DataFrame:
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("_quality")).where("_quality = 1").select("doc_id")
    return calibrate(measures.join(good, "doc_id"))


def rated(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Measures and verdict of every row of ``documents``; strata are languages.

    Null text has no words and fails the base; a null language is a stratum of its own; rows with a null
    id or without a label are judged but not learnt from; an id labelled both good and bad counts as bad.
    Repeated rows are judged alike.  Strata without enough good labels keep all that the base keeps.  An empty table gives an empty result, and without labels only the
    base rejects.
    """
    rows = stored(measured(documents.select("doc_id", _stratum(), "text")).drop("text"), "measures")
    out = judged(rows, _cutoffs(rows, labels))
    return out.select(
        "doc_id", *[F.col(f"_m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", "kept",
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that ``rated`` keeps, with all their columns."""
    # Kept as a table: measured once, and the filter cannot be pushed below the measures, which would repeat them.
    rows = documents.select(F.struct("*").alias("_row"), "doc_id", _stratum(), F.col("text").alias("_text"))
    rows = stored(measured(rows, "_text").drop("_text"), "measured-rows")
    return judged(rows, _cutoffs(rows.drop("_row"), labels)).where("kept").select("_row.*")
