"""Deduplicated upsert without history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.dedupe import latest_sales, pending
from stratum.specs import SPECS

SALES = SPECS["salestransactions"]


def winners(staging: DataFrame) -> DataFrame:
    """One row per pending transaction in the silver shape.

    The silver key admits no NULL, so rows without one never win.
    """
    return latest_sales(staging.where("transaction_id IS NOT NULL")).select(
        *SALES.business,
        F.col("inserted_at").alias("load_timestamp"),
        F.col("origin_date").alias("source_date"),
    )


def inserts(silver: DataFrame, staging: DataFrame) -> DataFrame:
    """Winners whose transaction is not in silver yet."""
    return winners(staging).join(silver.select("transaction_id"), "transaction_id", "left_anti")


def updates(silver: DataFrame, staging: DataFrame) -> DataFrame:
    """Winners that overwrite a silver row, whether or not they differ from it."""
    return winners(staging).join(silver.select("transaction_id"), "transaction_id", "left_semi")


def upsert(silver: DataFrame, staging: DataFrame) -> DataFrame:
    """Silver after the merge: every winner, plus the silver rows no winner replaces.

    Silver rows give way to any pending row of their transaction, so they meet the pending keys
    and need no ranking.  Both sides of that join hold a transaction once, so it has no hot
    key, and a small load lets the planner broadcast the keys and leave silver unshuffled.
    """
    best = winners(staging)
    replaced = pending(staging).select("transaction_id").distinct()
    kept = silver.join(replaced, "transaction_id", "left_anti")
    return best.unionByName(kept.select(*best.columns))


def mark_processed(staging: DataFrame) -> DataFrame:
    """Staging with the winning rows marked; the losers of a transaction stay pending.

    The rows without a transaction have a winner too: it is marked although silver refuses it.
    """
    used = latest_sales(staging).select("row_id", F.lit(True).alias("_used"))
    return (
        staging.join(used, "row_id", "left")
        .withColumn("merge_status", F.when(F.col("_used"), 1).otherwise(F.col("merge_status")))
        .select(*staging.columns)
    )
