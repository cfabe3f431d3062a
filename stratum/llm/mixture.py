"""Mix sources to target weights by cutting hash-ordered documents at exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import running_totals, salted_join, stored, word_count

#: Weights of the sources in the order of their names, repeated as often as needed.
WEIGHTS = (1, 2, 3)

#: No source is repeated more often than this.
MAX_EPOCHS = 3


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``source, source_size``: the weighted share of all sizes, at most ``max_epochs`` sizes.

    What is above the limit goes to the other sources by weight.  Sorted by limit per weight, the limited
    sources come first; the level of the rest is the first one that its own limit allows.
    """
    ranked = running_totals(
        sources.withColumns({"_one": F.lit(1), "_last": F.col("source").isNull()}),
        ["_last", "source"], {"_rank": "_one"}, purpose="source-ranks",
    )
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    limits = ranked.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * max_epochs).alias("_limit"))
    limits = limits.withColumn("_per_weight", F.col("_limit") / F.col("_w"))
    filled = stored(
        running_totals(limits, ["_per_weight", "_w", "source"], {"_limits": "_limit", "_ws": "_w"}, purpose="source-limits"),
        "source-levels",
    )
    total, weight_sum = filled.agg(F.sum("source_size"), F.sum("_w")).first()
    level = (F.lit(total).cast("long") - F.col("_limits")) / (F.lit(weight_sum).cast("long") - F.col("_ws"))
    common = (
        filled.withColumn("_level", level)
        .where("_level <= _per_weight")
        .agg(F.min_by("_level", F.struct("_per_weight", "_w", "source")))
        .first()[0]
    )
    limit = F.col("_limit").cast("double")
    share = F.col("_w") * F.lit(common).cast("double")
    return filled.select("source", "source_size", F.least(limit, F.coalesce(share, limit)).alias("target"))


def mixed(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix-1"
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, copies`` for every row of ``documents``.

    Sizes are words.  Inside its source a document has a place by the MD5 of seed and id; a source is
    taken whole as often as its target holds it, then in that order up to the rest of the target, to the
    word: ``taken`` counts the words.  ``copies`` is the same for whole documents: in the last round a
    document counts if at least half of it lies within the rest.

    Null text: size 0, taken 0, copies as for any document at its place.  Null source: a source of its
    own, last in order.  Null ids share one place in the order; rows that agree in id and size are taken
    one after another.  Repeated rows are separate rows.  An empty table gives an empty result.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = stored(
        documents.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"),
            F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("_group"),
        ),
        "sizes",
    )
    sources = sizes.groupBy("_group", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources.select("source", "source_size"), weights, max_epochs)
    budgets = targets.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("_group"),
        "source_size", "target", F.floor("target").alias("_budget"),
        F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).alias("_rounds"),
    )
    placed = running_totals(sizes, ["_key", "doc_id", "size"], {"_start": "size"}, "_group", "mix-order")
    joined = salted_join(placed, budgets, ["_group"], "inner")
    rest = F.col("_budget") - F.col("_rounds") * F.col("source_size")
    last = F.least(F.greatest(rest - F.col("_start"), F.lit(0)), F.col("size"))
    whole = (F.col("_start") + F.col("size") / 2 <= rest) & (rest > 0)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_rounds") * F.col("size") + last).alias("taken"),
        (F.col("_rounds") + whole.cast("long")).alias("copies"),
    )


def mix(documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix-1") -> DataFrame:
    """The rows of ``documents`` that the mix takes, whole and repeated as often as it takes them; same columns.

    Rows that agree in id, source and size are interchangeable for the mix: each gets the rounded mean of
    their copies upward in the order of their texts' hashes, so that the total stays the same.
    """
    counts = mixed(documents, weights, max_epochs, seed)
    rows = documents.select(
        F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
        word_count(F.col("text")).alias("_size"),
    )
    per_key = counts.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_n"))
    same = (
        F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_source").eqNullSafe(F.col("source"))
        & (F.col("_size") == F.col("size"))
    )
    joined = rows.join(per_key.where("_copies > 0"), same)
    one = joined.where("_n = 1").select("_row", F.col("_copies").alias("_times"))
    place = F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy(F.xxhash64("_row")))
    many = joined.where("_n > 1").select(
        "_row", (F.floor(F.col("_copies") / F.col("_n")) + (place <= F.col("_copies") % F.col("_n")).cast("long")).alias("_times")
    )
    return one.unionByName(many).where("_times > 0").select("_row", F.explode(F.sequence(F.lit(1), "_times"))).select("_row.*")
