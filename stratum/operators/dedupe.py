"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; NULL keys form a group of their own.

    The planner limits every map task to one row per key before the shuffle, so a hot key
    sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def pending(staging: DataFrame) -> DataFrame:
    return staging.where("merge_status = 0")


def latest_sales(staging: DataFrame) -> DataFrame:
    """Best pending row per transaction: batch number first, then load time, then row id."""
    return latest_per_key(
        pending(staging), ["transaction_id"], newest_first("batch_value", "inserted_at", "row_id")
    )


def latest_by_load_time(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest pending row per key; the row id settles rows of one file, which share a load time."""
    return latest_per_key(pending(staging), keys, newest_first("inserted_at", "row_id"))
