"""Plans whose shuffles and tasks must not outgrow the tables."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratum.operators import history, scd2
from stratum.plans import registry
from stratum.plans.given import GivenTables
from stratum.session import bound_tasks

_AT = datetime(1996, 1, 1)

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "INDIA", 0)]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "c", 0, 1.0, "BUILDING")]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 0, 1.0)]),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(1, "p", "b", "SMALL", 9, 950.0)],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        [(1, 1, "F", 1.0, _AT, "1-URGENT"), (2, 1, "O", 1.0, _AT, "1-URGENT")],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        [(1, 1, 1, 1, 2.0, 10.0, 0.0, 0.0, "N", "O", _AT), (2, 1, 1, 1, 3.0, 20.0, 0.0, 0.0, "N", "O", _AT)],
    ),
}


@pytest.fixture
def given(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return GivenTables(spark, str(tmp_path))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_a_large_shuffle_stay_small(spark):
    bound_tasks(spark)
    rows = spark.range(0, 6_000_000, 1, 8).select("id", *[F.rand(i).alias(f"r{i}") for i in range(3)])
    assert rows.repartition("id").rdd.getNumPartitions() > 8


def test_bounds_leave_what_the_session_says(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "5m")
    try:
        bound_tasks(spark)
        assert spark.conf.get(name) == "5m"
    finally:
        spark.conf.unset(name)


def test_lines_are_dealt_out_once_for_numbers_and_orders(given, no_broadcast):
    sales = given.salestransactions_staging()
    assert plan(sales).count("Exchange hashpartitioning") == 2  # lines, orders
    assert sales.count() == 2


def test_as_of_shuffles_versions_and_facts_once(spark, no_broadcast):
    versions = spark.createDataFrame([(1, _AT, None, "x")], "k long, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    facts = spark.createDataFrame([(7, 1, _AT), (8, 1, None), (9, None, _AT), (9, None, _AT)], "id long, k long, at timestamp_ntz")
    out = history.as_of(facts, versions, ["k"], "at")
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert sorted((r.id, r.asof_v) for r in out.collect() if r.id < 9) == [(7, "x"), (8, None)]
    assert [r.asof_v for r in out.where("id = 9").collect()] == [None, None]


def test_refresh_reads_stored_sales(given, monkeypatch):
    """Each refresh reads its sales several times, so they come from a table and not from the merge."""
    seen, refresh = [], registry.GoldTable.refresh

    def spy(self, sales, *rest, **more):
        seen.append(plan(sales))
        return refresh(self, sales, *rest, **more)

    monkeypatch.setattr(registry.GoldTable, "refresh", spy)
    assert registry.gold_refreshed(given).count() == 2
    assert len(seen) == 2 and not any("Exchange" in p for p in seen)


def test_stocks_that_are_active_twice_are_found_by_one_exchange_of_the_merge(spark, tmp_path, no_broadcast):
    schema, _ = TABLES["lineitem"]
    lines = [(order, 1, 1, 1, 1.0 + order, 10.0, 0.0, 0.0, "N", "O", _AT) for order in (1, 2, 3)]
    keyless = [(order, 2, 1, 1, 1.0, 10.0, 0.09, 0.08, "N", "O", _AT) for order in (4, 5)]
    spark.createDataFrame(lines + keyless, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = registry.all_queries()["dq_duplicate_active_stocks"](spark, str(tmp_path))
    assert plan(found).count("Exchange hashpartitioning") == 2  # history of stocks, and it with what is pending
    assert "Join" not in plan(found)
    assert {(r.key, r.n) for r in found.collect()} == {("1|1", 2), ("1|NULL", 2)}


def test_hot_stocks_are_sought_without_computing_which_are_active(spark, tmp_path, monkeypatch):
    schema, rows = TABLES["lineitem"]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    looked = []
    monkeypatch.setattr(scd2, "find_hot", lambda rows, keys, *_: looked.append(plan(rows.select(*keys))))
    assert registry.merged(GivenTables(spark, str(tmp_path)), "stocks").count() == 3
    assert len(looked) == 2 and not any("Exchange" in p for p in looked)


def test_clean_merge_of_stocks_deals_rows_out_once(spark, tmp_path, no_broadcast):
    schema, _ = TABLES["lineitem"]
    lines = [(order, 1, 1, 1, 1.0 + order, 10.0, 0.0, 0.01, "N", "O", _AT + timedelta(days=40 * order)) for order in (1, 2, 3)]
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    merged = registry.all_queries()["scd2_merge_clean_stocks"](spark, str(tmp_path))
    assert plan(merged).count("Exchange hashpartitioning") == 1
    days = lambda at: None if at is None else (at - _AT).days
    assert sorted((days(r.valid_from), days(r.valid_to), r.active) for r in merged.collect()) == [
        (40, 80, False), (80, 120, False), (120, 150, False), (150, None, True)
    ]


def _shuffle_files(spark) -> set[str]:
    """Names of those with rows."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}


def test_refresh_leaves_no_shuffle_files(spark, given):
    before, setting = _shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    gold = registry.gold_refreshed(given)
    until = time.monotonic() + 20
    while _shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)  # they are removed in the background
    assert not _shuffle_files(spark) - before
    assert gold.count() == 2 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
