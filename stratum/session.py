"""Session settings the operators rely on; all can be changed while a session runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SETTINGS = {
    # With this on, Spark 4.1 may plan an aggregate on the partitioning its union's inputs share and
    # then, where one input reuses an exchange, just concatenate them: groups come out split.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Unless the session says otherwise.  Rows compress well, so that 64 MB of a shuffle, Spark's default, fill a gigabyte of a
# task's sorts; and with few shuffle partitions the rows of a task grow with the table.  Small ones are put together.
_BOUNDS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings and return the session."""
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Apply the settings, and those that keep the tasks of large shuffles small; return the session."""
    for name, value in _BOUNDS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return prepare(spark)
