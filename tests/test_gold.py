from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest

from stratum.operators import gold, scd1
from stratum.schemas import GOLD_SALES, silver_schema, staging_schema

T = datetime(2024, 5, 5)
TAIL = (T, None, True, T, T.date())
CLOSED = (T, T, False, T, T.date())


@pytest.fixture(scope="module")
def tables(spark):
    make = lambda entity, rows: spark.createDataFrame(rows, silver_schema(entity))
    sale = lambda i, c, f, q, amount: (i, c, f, q, T.date(), "c", "t", "p", amount, T, T.date())
    return {
        "sales": make(
            "salestransactions",
            [sale(1, 1, 1, 2.0, 10.0), sale(2, 2, 1, 1.0, 1.0), sale(3, 1, 2, 1.0, 1.0), sale(4, 1, 3, 1.0, 9.0),
             sale(5, 9, 1, 1.0, 1.0), sale(6, None, 1, 1.0, 1.0), sale(7, 1, 4, 1.0, 1.0)],
        ),
        "customers": make(
            "customers", [(1, "ann", "x", "y", *TAIL), (2, "bob", "x", "y", *CLOSED), (1, "old", "x", "y", *CLOSED)]
        ),
        "flavours": make("flavours", [(f, f"f{f}", "d", *TAIL) for f in (1, 2, 3, 4)]),
        "recipes": make(
            "recipes",
            [(1, 1, 1, 1.0, "h", *TAIL), (1, 1, 2, 3.0, "h", *TAIL), (1, 1, 2, 100.0, "h", *CLOSED),
             (2, 2, 1, 0.0, "h", *TAIL), (3, 3, 3, 1.0, "h", *TAIL)],
        ),
        "ingredients": make(
            "ingredients",
            [(1, "i1", "F", 1.0, 4.0, 1, *TAIL), (2, "i2", "F", 1.0, 0.02, 1, *TAIL), (3, "i3", "F", 1.0, 1.005, 1, *TAIL),
             (3, "i3", "F", 1.0, 99.0, 1, *CLOSED)],
        ),
    }


def test_cost_is_weighted_and_rounded(tables):
    cost = {r.flavour_id: r.cost_per_liter for r in gold.cost_per_flavour(tables["recipes"], tables["ingredients"]).collect()}
    assert {k: None if v is None else float(v) for k, v in cost.items()} == {1: 1.02, 2: None, 3: 1.01}


def test_sales_need_an_active_customer_a_flavour_and_a_cost_row(tables):
    view = gold.sales_analytics(*tables.values())
    assert view.schema.simpleString() == GOLD_SALES.simpleString()
    rows = {r.transaction_id: (r.customer_name, r.flavour_name, r.cost_per_liter, r.total_cost, r.profit) for r in view.collect()}
    assert rows == {
        1: ("ann", "f1", 1.02, 2.04, 7.96),
        3: ("ann", "f2", None, None, None),
        4: ("ann", "f3", 1.01, 1.01, 7.99),
    }


def test_hot_keys_and_repeated_sales_change_nothing(tables):
    view = Counter(map(tuple, gold.sales_analytics(*tables.values()).collect()))
    salted = gold.sales_analytics(*tables.values(), hot_rows=1, look=1.0)
    assert Counter(map(tuple, salted.collect())) == view
    twice = {**tables, "sales": tables["sales"].unionByName(tables["sales"])}
    assert Counter(map(tuple, gold.sales_analytics(*twice.values(), unique_sales=False).collect())) == view


def test_customer_active_twice_under_two_names_doubles_sales(spark, tables):
    more = spark.createDataFrame([(1, "anna", "x", "y", *TAIL), (1, "ann", "z", "z", *TAIL)], silver_schema("customers"))
    both = {**tables, "customers": tables["customers"].unionByName(more)}
    rows = gold.sales_analytics(*both.values()).where("transaction_id = 1").collect()
    assert sorted(r.customer_name for r in rows) == ["ann", "anna"]


def test_view_is_registered(spark, tables):
    gold.create_view(gold.sales_analytics(*tables.values()))
    assert spark.table("vw_salestransaction_analytics").count() == 3


def test_upsert_takes_the_batch_before_the_load_time(spark):
    def row(i, tx, amount, day, batch, status=0):
        loaded = datetime(2024, 5, day)
        return (i, tx, 1, 1, 1.0, T.date(), "c", "t", "p", amount, loaded, batch, loaded.date(), status)

    staging = spark.createDataFrame(
        [row(1, 1, 10.0, 7, 1), row(2, 1, 20.0, 6, 2), row(3, 2, 30.0, 6, 0), row(4, 2, 40.0, 6, 0),
         row(5, None, 50.0, 6, 0), row(6, 3, 60.0, 6, 0, 1)],
        staging_schema("salestransactions"),
    )
    known = [(1, 1, 1, 1.0, T.date(), "c", "t", "p", 1.0, T, T.date()), (3, 1, 1, 1.0, T.date(), "c", "t", "p", 3.0, T, T.date())]
    silver = spark.createDataFrame(known, silver_schema("salestransactions"))
    merged = {r.transaction_id: r.amount_dollar for r in scd1.upsert(silver, staging).collect()}
    assert merged == {1: 20.0, 2: 40.0, 3: 3.0}
    assert [r.transaction_id for r in scd1.inserts(silver, staging).collect()] == [2]
    assert [r.transaction_id for r in scd1.updates(silver, staging).collect()] == [1]
    marked = {r.row_id: r.merge_status for r in scd1.mark_processed(staging).collect()}
    assert marked == {1: 0, 2: 1, 3: 0, 4: 1, 5: 1, 6: 1}
