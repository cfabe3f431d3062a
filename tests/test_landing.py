"""Ingest from plain single-file deliveries written outside Spark."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratum.schemas import empty, staging_schema
from stratum.sources import landing

LOADED = datetime(2024, 5, 8, 6)

FILES = {
    "20240506/Flavours_20240506_1.csv": "flavour_id,name,description\n1,mint,fresh\n2,\"a, b\",\n",
    # Other column order, other case, one column more, a whole number with decimals.
    "20240507/Flavours_20240507_2.csv": "extra,Description,NAME,flavour_id\nx,sweet,honey,3\ny,sour,lemon,4.0\n",
    "20240507/flavours_20240507.csv": "flavour_id,name,description\n5,salt,plain\n",
    "20240508/Flavours_20240508_1.csv": "flavour_id,name,description\n6,good,row\nsix,bad,row\n",
    "20240508/Flavours_20240508_2.csv": "flavour_id,name\n7,no description\n",
    "20240508/Flavours_2024058_3.csv": "flavour_id,name,description\n8,bad,date\n",
    "20240508/Flavours_20241341_3.csv": "flavour_id,name,description\n8,bad,month\n",
    "20240508/Flavours_20240508_x.csv": "flavour_id,name,description\n9,bad,batch\n",
    "20240508/Visits_20240508_1.csv": "id\n1\n",
    "20240508/Flavours.csv": "flavour_id,name,description\n10,no,date\n",
    "20240508/Flavours_20240508_9.txt": "flavour_id,name,description\n11,not,csv\n",
}


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def deliveries(spark, landed):
    return landing.manifest(landing.list_files(spark, landed))


def test_manifest(deliveries):
    rows = {r.file_name: (r.staging_table, r.origin_date, r.batch_value, r.reason) for r in deliveries.collect()}
    flavours = "dp_flavours_staging"
    assert rows == {
        "Flavours_20240506_1.csv": (flavours, date(2024, 5, 6), 1, None),
        "Flavours_20240507_2.csv": (flavours, date(2024, 5, 7), 2, None),
        "flavours_20240507.csv": (flavours, date(2024, 5, 7), 0, None),
        "Flavours_20240508_1.csv": (flavours, date(2024, 5, 8), 1, None),
        "Flavours_20240508_2.csv": (flavours, date(2024, 5, 8), 2, None),
        "Flavours_2024058_3.csv": (flavours, None, 3, "bad date"),
        "Flavours_20241341_3.csv": (flavours, None, 3, "bad date"),
        "Flavours_20240508_x.csv": (flavours, date(2024, 5, 8), None, "bad batch"),
        "Visits_20240508_1.csv": ("dp_visits_staging", date(2024, 5, 8), 1, "unknown table"),
    }


def test_missing_tables(deliveries):
    missing = landing.missing_tables(deliveries, ["dp_visits_staging"])
    assert [r.staging_table for r in missing.collect()] == ["dp_flavours_staging"]


def test_load_binds_by_name_and_rejects_whole_files(spark, deliveries):
    load = landing.load(spark, deliveries, "flavours", LOADED)
    assert load.rows.schema.simpleString() == staging_schema("flavours").simpleString()
    rows = {(r.flavour_id, r.name, r.description, r.batch_value, r.origin_date.day) for r in load.rows.collect()}
    assert rows == {
        (1, "mint", "fresh", 1, 6), (2, "a, b", None, 1, 6), (3, "honey", "sweet", 2, 7), (4, "lemon", "sour", 2, 7),
        (5, "salt", "plain", 0, 7),
    }
    assert {(r.inserted_at, r.merge_status) for r in load.rows.collect()} == {(LOADED, 0)}
    rejects = {r.delivery.rsplit("/", 1)[1]: r.reason for r in load.rejects.collect()}
    assert rejects == {
        "Flavours_20240508_1.csv": "bad value",
        "Flavours_20240508_2.csv": "missing column description",
        "Flavours_2024058_3.csv": "bad date",
        "Flavours_20241341_3.csv": "bad date",
        "Flavours_20240508_x.csv": "bad batch",
    }


def test_row_ids_go_on_above_the_existing_ones(spark, deliveries):
    first = landing.load(spark, deliveries, "flavours", LOADED).rows
    top = first.agg(F.max("row_id")).first()[0]
    second = landing.load(spark, deliveries, "flavours", LOADED, existing=first).rows
    assert first.select("row_id").distinct().count() == 5
    assert second.agg(F.min("row_id")).first()[0] > top


def test_append_and_read(spark, deliveries, tmp_path):
    rows = landing.load(spark, deliveries, "flavours", LOADED).rows
    landing.append(rows, str(tmp_path), "flavours")
    landing.append(rows, str(tmp_path), "flavours")
    stored = landing.read_staging(spark, str(tmp_path), "flavours")
    assert stored.schema == staging_schema("flavours") and stored.count() == 10
    one_day = stored.where("origin_date = DATE '2024-05-06'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() == 4 and "PartitionFilters: [isnotnull(origin_date" in plan


def test_only_named_columns_are_parsed(spark, deliveries):
    found = landing.probe(spark, deliveries, "flavours")
    plan = landing.scan(spark, "flavours", found).select("name")._jdf.queryExecution().executedPlan().toString()
    assert "c3" not in plan and "CartesianProduct" not in plan


def test_no_deliveries(spark, deliveries):
    load = landing.load(spark, deliveries, "stocks", LOADED)
    assert load.rows.count() == 0 and load.rows.columns == staging_schema("stocks").fieldNames() and load.rejects.count() == 0


def test_typed_empty_tables(spark):
    assert empty(spark, staging_schema("recipes")).columns[:2] == ["row_id", "recipe_id"]
