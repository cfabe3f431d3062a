"""History against a direct reading of it, with hot keys, tied times and reversed versions."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators import history
from stratum.operators.ordered import KeyedSequence
from stratum.operators.skew import find_hot_ranges

START, END = datetime(2024, 1, 1), datetime(9999, 12, 31)
VERSIONS = "k long, g string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string, size double"
FACTS = "id long, k long, g string, on timestamp_ntz, name string"

TUNINGS = [{}, {"hot_rows": 20, "look": 1.0}]


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def maybe(rnd, value, p=0.05):
    return None if rnd.random() < p else value


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(6)
    keys = [(1, "a")] * 6 + [(1, "b"), (2, "a"), (3, "c")]
    versions, facts = [], []
    for _ in range(500):
        k, g = rnd.choice(keys)
        begin = rnd.choice([rnd.randint(0, 300), 50, 51])
        end = maybe(rnd, begin + rnd.randint(-5, 40), 0.2)
        versions.append((maybe(rnd, k), g, maybe(rnd, at(begin)), at(end), maybe(rnd, rnd.choice("xyz"), 0.3), rnd.choice([None, 1.0, 2.5])))
    for i in range(800):
        k, g = rnd.choice(keys)
        facts.append((i, maybe(rnd, k), maybe(rnd, g), maybe(rnd, at(rnd.choice([rnd.randint(-20, 320), 50, 50, 50]))), "own"))
    return versions, facts


def low(x):
    return (x is not None, x if x is not None else 0)


def begun(versions):
    """The counting version of each key and begin."""
    out = {}
    for k, g, f, t, name, size in versions:
        if None not in (k, g, f):
            rank = t or END, low(name) if name is not None else (False, ""), low(size)
            out[k, g, f] = max(out.get((k, g, f), (rank, None)), (rank, None), key=lambda x: x[0])
    return {key: (rank[0], rank[1][1] if rank[1][0] else None, rank[2][1] if rank[2][0] else None) for key, (rank, _) in out.items()}


@pytest.mark.parametrize("tuning", TUNINGS)
def test_as_of(spark, data, tuning):
    versions, facts = data
    starts = begun(versions)
    expected = Counter()
    for i, k, g, on, own in facts:
        past = [f for kk, gg, f in starts if (kk, gg) == (k, g) and on is not None and f <= on]
        end, name, size = starts[k, g, max(past)] if past else (START, None, None)
        expected[i, k, g, on, own, *((name, size) if past and on < end else (None, None))] += 1
    found = history.as_of(spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), ["k", "g"], "on", **tuning)
    assert found.columns == ["id", "k", "g", "on", "name", "asof_name", "asof_size"]
    assert Counter(map(tuple, found.collect())) == expected


def test_as_of_has_no_range_join_and_spreads_a_hot_key(spark):
    """One key has all the rows, half of them at one time."""
    hour = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, cast(h as int))")
    facts = spark.range(4000).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, 77).otherwise(F.col("id") % 500).alias("h"), F.col("id").alias("fact")).select("k", hour.alias("on"), "fact")
    versions = spark.range(600).select(F.lit(1).alias("k"), F.col("id").alias("h"), "id").select(
        "k", hour.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), "id"
    )
    found = history.as_of(facts, versions, ["k"], "on", hot_rows=100, look=1.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = history.as_of(facts, versions, ["k"], "on", hot_rows=100, look=1.0)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 1500
    assert found.where("asof_id <> (unix_seconds(cast(on as timestamp)) - 1704067200) / 3600").count() == 0


@pytest.mark.parametrize("tuning", TUNINGS)
def test_change_log(spark, data, tuning):
    versions, _ = data
    starts = begun(versions)
    expected, last = Counter(), {}
    text = lambda v: v if v is None or isinstance(v, str) else str(v)
    for (k, g, f), (_, name, size) in sorted(starts.items()):
        if (k, g) in last:
            for attribute, old, new in zip(("name", "size"), last[k, g], (name, size), strict=True):
                if old != new:
                    expected[k, g, f, attribute, text(old), text(new)] += 1
        last[k, g] = name, size
    found = history.change_log(spark.createDataFrame(versions, VERSIONS), ["k", "g"], **tuning)
    assert found.columns == ["k", "g", "changed_at", "attribute", "old_value", "new_value"]
    assert Counter(map(tuple, found.collect())) == expected


def test_snapshot(spark, data):
    versions, _ = data
    expected = Counter(v for v in versions if v[2] is not None and v[2] <= at(50) and (v[3] is None or v[3] > at(50)))
    assert Counter(map(tuple, history.snapshot(spark.createDataFrame(versions, VERSIONS), at(50)).collect())) == expected


def test_empty(spark):
    none, facts = spark.createDataFrame([], VERSIONS), spark.createDataFrame([(1, 1, "a", START, "own")], FACTS)
    assert history.as_of(facts, none, ["k", "g"], "on").collect() == [(1, 1, "a", START, "own", None, None)]
    assert history.as_of(facts.limit(0), none, ["k", "g"], "on").count() == history.change_log(none, ["k", "g"]).count() == 0


def test_slices_hold_equal_shares_of_crowded_times(spark):
    """Times crowd towards the end: equal widths would put nearly all rows into one slice."""
    rows = spark.range(4000).select(
        F.lit(1).alias("k"), F.timestamp_micros((F.lit(10**15) - F.pow(F.lit(1.9), F.col("id") % 40) * 1000 - F.col("id")).cast("long")).cast("timestamp_ntz").alias("at"), F.col("id").alias("v")
    )
    hot = find_hot_ranges(rows, ["k"], "at", hot_rows=100, look=1.0)
    sequence = KeyedSequence(rows, ["k"], "at", hot)
    sizes = [r["count"] for r in sequence.rows.groupBy("_slice").count().collect()]
    assert len(sizes) >= 38 and max(sizes) <= 220
    w = Window.partitionBy("k").orderBy("at")
    value = F.when(F.col("v") % 7 == 0, F.struct("v"))
    plain = rows.withColumn("x", F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sliced = sequence.last_known(sequence.rows, value, "x").select("k", "at", "v", "x")
    assert Counter(map(tuple, sliced.collect())) == Counter(map(tuple, plain.collect()))
    number = sequence.number(sequence.rows, "x").select("k", "at", "v", "x")
    assert Counter(map(tuple, number.collect())) == Counter(map(tuple, rows.withColumn("x", F.row_number().over(w)).collect()))
