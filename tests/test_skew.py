from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators.ordered import KeyedSequence
from stratum.operators.skew import find_hot, find_hot_ranges, skew_join


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of the rows, NULL another third."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50 + 1)
    return spark.range(3000).select(key.alias("k"), F.col("id").alias("v"))


def test_find_hot(skewed):
    hot = {r.k: r._salts for r in find_hot(skewed, ["k"], hot_rows=100, look=1.0).collect()}
    assert hot == {0: 10, None: 10}
    assert find_hot(skewed, ["k"], hot_rows=5000) is None
    sampled = {r.k for r in find_hot(skewed, ["k"], hot_rows=500, look=0.5).collect()}
    assert sampled == {0, None}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, skewed, how):
    lookup = spark.createDataFrame([(0, "zero"), (0, "null"), (7, "seven"), (None, "none")], "k long, name string")
    hot = find_hot(skewed, ["k"], hot_rows=100, look=1.0)
    assert rows(skew_join(skewed, lookup, ["k"], how, hot)) == rows(skewed.join(lookup, "k", how))


def test_hot_key_spreads_over_salts(spark, skewed):
    lookup = spark.createDataFrame([(0, "zero")], "k long, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = find_hot(skewed, ["k"], hot_rows=100, look=1.0)
        joined = skew_join(skewed, lookup, ["k"], "inner", hot)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 1000 and max(sizes) < 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_right_and_full_joins_are_refused(spark, skewed):
    with pytest.raises(ValueError, match="full"):
        skew_join(skewed, skewed, ["k"], "full", None)


def test_sliced_windows_equal_plain_windows(spark):
    at = F.timestamp_seconds(F.col("id") * 37 % 4999).cast("timestamp_ntz")
    key = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 20)
    df = spark.range(2000).select(key.alias("k"), at.alias("at"), F.col("id").alias("v"))
    hot = find_hot_ranges(df, ["k"], "at", hot_rows=100, look=1.0)
    assert hot.count() == 1
    seq = KeyedSequence(df, ["k"], "at", hot)
    assert seq.rows.where("k = 0").select("_slice").distinct().count() == 10
    w = Window.partitionBy("k").orderBy("at")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    value = F.struct("v")
    pairs = [
        (seq.previous(seq.rows, value, "x"), F.lag(value).over(w)),
        (seq.next(seq.rows, "x"), F.lead("at").over(w)),
        (seq.max_before(seq.rows, "v", "x"), F.max("v").over(before)),
        (seq.running_sum(seq.rows, "v", "x"), F.sum("v").over(w)),
    ]
    for sliced, plain in pairs:
        assert rows(sliced.select("k", "at", "v", "x")) == rows(df.withColumn("x", plain))
