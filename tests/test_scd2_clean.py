"""Properties and scenarios of the clean merge."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratum.operators import quality
from stratum.operators.scd2 import split_history
from stratum.operators.scd2_clean import CleanMerge, mark_all_processed, merge
from stratum.schemas import silver_schema, staging_schema
from stratum.specs import SPECS
from tests.test_scd2_literal import DAY, ENTITY, frame, random_tables

SPEC = SPECS["flavours"]
T1, T2, T3 = (DAY + timedelta(days=d) for d in (1, 2, 3))


def rows(df):
    return Counter(map(tuple, df.collect()))


def staged(spark, *versions):
    """(key, name, time) or (key, name, time, row id) as pending flavours."""
    data = []
    for i, (key, name, at, *rest) in enumerate(versions):
        data.append((rest[0] if rest else i + 1, key, name, "d", at, 0, at.date(), 0))
    return spark.createDataFrame(data, staging_schema("flavours"))


def silver(spark, *versions):
    data = [(key, name, "d", at, None, True, at, at.date()) for key, name, at in versions]
    return spark.createDataFrame(data, silver_schema("flavours"))


def outcome(df):
    return sorted((r.flavour_id, r.name or "", r.valid_from, r.valid_to or datetime.max, r.active) for r in df.collect())


E = datetime.max
SCENARIOS = {
    "new key": ([], [(1, "a", T1)], [(1, "a", T1, E, True)]),
    "unchanged": ([(1, "a", T1)], [(1, "a", T2)], [(1, "a", T1, E, True)]),
    "changed": ([(1, "a", T1)], [(1, "b", T2)], [(1, "a", T1, T2, False), (1, "b", T2, E, True)]),
    "two versions in one run": (
        [(1, "a", T1)], [(1, "b", T2), (1, "c", T3)],
        [(1, "a", T1, T2, False), (1, "b", T2, T3, False), (1, "c", T3, E, True)],
    ),
    "new key twice": ([], [(1, "a", T1), (1, "b", T2)], [(1, "a", T1, T2, False), (1, "b", T2, E, True)]),
    "to NULL and back": (
        [(1, "a", T1)], [(1, None, T2), (1, "a", T3)],
        [(1, "", T2, T3, False), (1, "a", T1, T2, False), (1, "a", T3, E, True)],
    ),
    "tie": ([(1, "a", T1)], [(1, "b", T2, 1), (1, "c", T2, 2)], [(1, "a", T1, T2, False), (1, "c", T2, E, True)]),
    "late": ([(1, "b", T2)], [(1, "a", T1)], [(1, "b", T2, E, True)]),
    "same time as the active version": ([(1, "b", T2)], [(1, "a", T2)], [(1, "b", T2, E, True)]),
}


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenario(spark, name):
    before, pending, expected = SCENARIOS[name]
    assert outcome(merge(SPEC, silver(spark, *before), staged(spark, *pending))) == sorted(expected)


def test_rejected_and_late_rows_are_reported(spark):
    active, _ = split_history(silver(spark, (1, "a", T2)))
    run = CleanMerge(SPEC, active, staged(spark, (None, "x", T3), (1, "b", T1), (1, "c", T3)))
    assert [r.name for r in run.rejected().collect()] == ["x"]
    assert [r.name for r in run.late().collect()] == ["b"]


@pytest.mark.parametrize("style", "ABCD")
def test_properties_on_random_tables(spark, style):
    spec = SPECS[ENTITY[style]]
    _, staging = random_tables(spec, 23)
    pending = frame(spark, staging, staging_schema(spec.entity))
    nothing = spark.createDataFrame([], silver_schema(spec.entity))
    once = merge(spec, nothing, pending).cache()
    assert quality.duplicates(once, "t", list(spec.keys), active_only=True).isEmpty()
    assert quality.overlap_keys(once, list(spec.keys)).isEmpty()
    assert quality.overlap_pairs(once, list(spec.keys)).first().n == 0
    assert quality.date_order(once, "t").first().n == 0
    # Merging the same rows again changes nothing: they are late or unchanged.
    assert rows(merge(spec, once, pending)) == rows(once)
    # One merge per load time gives the same table as one merge of everything.
    halves = [pending.where(F.col("inserted_at") == DAY + timedelta(days=d)) for d in (1, 2)]
    assert rows(merge(spec, merge(spec, nothing, halves[0]), halves[1])) == rows(once)
    assert rows(merge(spec, nothing, pending, hot_rows=2, look=1.0)) == rows(once)
    assert mark_all_processed(pending).where("merge_status = 0").isEmpty()


def test_hot_key_is_cut_into_slices(spark):
    """One key with three quarters of all rows: same history with and without slices."""
    versions = [(1, "abc"[i // 7 % 3], DAY + timedelta(minutes=i)) for i in range(1, 300)]
    versions += [(k, "ab"[i % 2], DAY + timedelta(minutes=i)) for k in range(2, 12) for i in range(1, 10)]
    pending = staged(spark, *versions)
    before = silver(spark, (1, "a", DAY), (5, "z", DAY))
    assert rows(merge(SPEC, before, pending, hot_rows=20, look=1.0)) == rows(merge(SPEC, before, pending))
