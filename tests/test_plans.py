"""Physical plans: what is shuffled, what reaches the scan, and what must not occur."""

from __future__ import annotations

import os

import pytest

from stratum.operators import dedupe, scd1, scd2
from stratum.plans import registry
from stratum.plans.given import GivenTables
from stratum.schemas import empty, silver_schema, staging_schema
from stratum.specs import SPECS

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def given(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("given tables are not here")
    return GivenTables(spark, FOLDER)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SILVER_QUERIES = [
    "gold_sales_analytics", "scd1_upsert_sales", "antijoin_not_in", "dq_overlap_pairs", "dq_overlap_keys",
    *[f"scd2_merge_{e}" for e in ("customers", "ingredients", "recipes", "stocks")], "scd2_merge_clean",
]


@pytest.mark.parametrize("name", SILVER_QUERIES)
def test_no_cross_or_nested_loop_join_and_no_python(spark, given, name):
    text = plan(registry.all_queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "isNullAware", "Python", "Pandas"):
        assert operator not in text, operator


@pytest.mark.parametrize("name", SILVER_QUERIES)
def test_nothing_is_collected_into_one_partition_but_counts(spark, given, name):
    """Only global aggregates (one row per task) meet in a single partition."""
    text = plan(registry.all_queries()[name](spark, FOLDER)).splitlines()
    for i, line in enumerate(text):
        if "Exchange SinglePartition" in line:
            assert "partial_" in text[i + 1], text[i + 1]


def test_newest_row_is_chosen_before_the_shuffle(spark):
    rows = empty(spark, staging_schema("ingredients")).repartition(4)
    text = plan(dedupe.latest_by_load_time(rows, ["ingredient_id"]))
    above, below = text.split("Exchange hashpartitioning(ingredient_id", 1)
    assert "Final" in above and "WindowGroupLimit" in below and "Partial" in below


def test_gold_reads_only_the_columns_it_needs(given):
    text = plan(registry.gold_sales(given))
    for unused in ("c_mktsegment", "p_retailprice", "o_totalprice", "l_tax"):
        assert unused not in text
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,5)" in text


def test_a_small_load_leaves_silver_unshuffled(spark, tmp_path):
    """Upsert: the pending keys are broadcast, stored silver rows stay where they are."""
    silver = str(tmp_path / "silver")
    spark.createDataFrame([], silver_schema("salestransactions")).write.parquet(silver)
    staging = str(tmp_path / "staging")
    spark.createDataFrame([], staging_schema("salestransactions")).write.parquet(staging)
    text = plan(scd1.upsert(spark.read.parquet(silver), spark.read.parquet(staging)))
    kept = text.split("Union", 1)[1]
    anti = [line for line in kept.splitlines() if "LeftAnti" in line]
    assert len(anti) == 1 and "BroadcastHashJoin" in anti[0]


def test_small_pending_keys_filter_active_rows_in_place(spark, no_broadcast, given):
    spec = SPECS["flavours"]
    active, _ = scd2.split_history(given.flavours_silver())
    run = scd2.LiteralMerge(spec, active, given.flavours_staging(), broadcast_pending=True)
    assert "BroadcastHashJoin" in plan(run.key_stats) and "LeftSemi" in plan(run.key_stats)
    assert "SortMergeJoin" not in plan(run._active_with_end)


def test_closed_history_is_not_joined(given):
    """The inactive branch of a merge result is a filtered scan."""
    text = plan(registry.merged(given, "recipes"))
    branch = text.split("Union", 1)[1].splitlines()[1:5]
    assert not any("Join" in line or "Exchange" in line for line in branch)
    assert any("NOT" in line or "<>" in line for line in branch)
