from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from stratum.operators import quality
from stratum.schemas import silver_schema, staging_schema

START = datetime(2024, 1, 1)
SCHEMA = "k long, valid_from timestamp_ntz, valid_to timestamp_ntz, active boolean"


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def intervals(seed, n, keys, span):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        key = None if rnd.random() < 0.03 else rnd.choice(keys)
        begin = None if rnd.random() < 0.03 else rnd.randint(0, span)
        end = None if rnd.random() < 0.1 or begin is None else begin + rnd.randint(-8, 12)
        out.append((key, at(begin), at(end), end is None))
    return out


def count_pairs(rows):
    closed = [(k, f, t) for k, f, t, _ in rows if None not in (k, f, t)]
    return sum(
        a[0] == b[0] and a[1] < b[2] and a[2] > b[1] and (a[1] != b[1] or a[2] != b[2]) for a in closed for b in closed
    )


@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 20, "look": 1.0}])
def test_overlap_pairs_against_all_pairs(spark, tuning):
    rows = intervals(3, 400, [1, 1, 1, 2, 3, 4], 60)
    df = spark.createDataFrame(rows, SCHEMA)
    assert quality.overlap_pairs(df, ["k"], **tuning).first().n == count_pairs(rows) > 0


def test_overlap_pairs_of_nothing(spark):
    assert quality.overlap_pairs(spark.createDataFrame([], SCHEMA), ["k"]).first().n == 0


def overlap_counts(rows, keys):
    expected: Counter = Counter()
    for k in keys:
        latest = None
        mine = [(f, t or datetime(9999, 12, 31)) for kk, f, t, _ in rows if kk == k and f is not None]
        for begin, end in sorted(mine):
            expected[k] += latest is not None and begin < latest
            latest = end if latest is None else max(latest, end)
    return {k: n for k, n in expected.items() if n}


@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 20, "look": 1.0}])
def test_overlap_keys_against_a_sweep(spark, tuning):
    rows = intervals(4, 300, [1, 1, 1, 2, 3], 900)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.k: r.n for r in quality.overlap_keys(df, ["k"], **tuning).collect()}
    assert found == overlap_counts(rows, (1, 2, 3))


def test_one_key_and_one_time_with_many_slices_worth_of_rows(spark):
    """Begins, ends and reversed versions that tie in time: hundreds of times what a slice may hold."""
    rnd = random.Random(8)
    rows = [(1, at(50), at(50 + rnd.randint(-3, 3)), False) for _ in range(1500)]
    rows += [(1, at(rnd.choice([49, 50, 51])), at(50), False) for _ in range(500)] + intervals(9, 60, [1, 2], 90)
    df = spark.createDataFrame(rows, SCHEMA)
    found = quality.overlap_pairs(df, ["k"], hot_rows=5, look=1.0).first().n
    assert found == quality.overlap_pairs(df, ["k"]).first().n == count_pairs(rows)
    tuned, plain = ({r.k: r.n for r in quality.overlap_keys(df, ["k"], **t).collect()} for t in ({"hot_rows": 5, "look": 1.0}, {}))
    assert tuned == plain == overlap_counts(rows, (1, 2))


def test_date_order_and_counts(spark):
    rows = [(1, at(1), at(1), False), (1, at(2), at(3), False), (1, at(5), at(4), False), (1, at(6), None, True)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert quality.date_order(df, "t").first().n == 2
    assert {r.key: r.n for r in quality.row_counts(df, "t").collect()} == {"all": 4, "active": 1, "inactive": 3}


def test_enforce_raises_only_on_errors(spark):
    t = START
    row = lambda i, name: (i, name, "F", 1.0, 1.0, 1, t, None, True, t, t.date())
    good = spark.createDataFrame([row(1, "a"), row(2, "b")], silver_schema("ingredients"))
    quality.enforce(quality.silver_checks(good, "ingredients"))
    twice = spark.createDataFrame([row(1, "a"), row(1, "b")], silver_schema("ingredients"))
    with pytest.raises(quality.QualityError, match="duplicate_active in ingredients"):
        quality.enforce(quality.silver_checks(twice, "ingredients"))
    nameless = spark.createDataFrame([row(1, None)], silver_schema("ingredients"))
    with pytest.raises(quality.QualityError, match="null_key"):
        quality.enforce(quality.silver_checks(nameless, "ingredients"))
    warned = spark.createDataFrame([(None, "a", "b", "c", t, None, True, t, t.date())], silver_schema("customers"))
    report = quality.silver_checks(warned, "customers")
    quality.enforce(report)
    assert report.where("check = 'null_key' AND n = 1 AND severity = 'warning'").count() == 1


def test_unprocessed_lists_rows_in_full(spark):
    rows = [(i, 1, 2, 3, 5.0, "x", START, 0, START.date(), i % 2) for i in range(4)]
    df = spark.createDataFrame([(r[0], *r[1:4], *r[4:]) for r in rows], staging_schema("recipes"))
    left = quality.unprocessed(df, "recipes")
    assert left.columns == [
        "row_id", "recipe_id", "flavour_id", "ingredient_id", "quantity_grams", "heat_process", "inserted_at"
    ]
    assert {r.row_id for r in left.collect()} == {0, 2}
