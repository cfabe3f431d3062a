"""Stored gold, refreshed by change, against computing it anew."""

from __future__ import annotations

import os
from collections import Counter
from datetime import date, datetime

import pytest

from stratum.operators import gold
from stratum.schemas import silver_schema
from stratum.sources.gold_table import NO_MONTH, GoldTable

T = datetime(2024, 5, 5)
TAIL = (T, None, True, T, T.date())
CLOSED = (T, T, False, T, T.date())

SALES = {1: (1, 1, date(2024, 1, 3)), 2: (2, 2, date(2024, 2, 3)), 3: (1, 3, date(2024, 3, 3)), 4: (1, 1, date(2024, 4, 3)),
         5: (2, 1, date(2024, 4, 4)), 6: (1, 1, None), 7: (9, 1, date(2024, 2, 9)), 8: (None, 1, date(2024, 2, 9))}


def inputs(spark, sales=SALES, prices=(1.0, 2.0, 3.0), second=TAIL):
    make = lambda entity, rows: spark.createDataFrame(rows, silver_schema(entity)).coalesce(1)
    return [
        make("salestransactions", [(i, c, f, 2.0, d, "c", "t", "p", 10.0, T, T.date()) for i, (c, f, d) in sales.items()]),
        make("customers", [(1, "ann", "x", "y", *TAIL), (2, "bob", "x", "y", *second)]),
        make("flavours", [(f, f"f{f}", "d", *TAIL) for f in (1, 2, 3)]),
        make("recipes", [(f, f, f, 1.0, "h", *TAIL) for f in (1, 2, 3)]),
        make("ingredients", [(i + 1, "i", "F", 1.0, p, 1, *TAIL) for i, p in enumerate(prices)]),
    ]


def rows(df):
    return Counter(map(tuple, df.collect()))


def files(path):
    return {m: sorted(f for f in os.listdir(path / m) if f.startswith("part-")) for m in os.listdir(path) if m.startswith("month=")}


def ids(spark, *changed):
    return spark.createDataFrame([(i,) for i in changed], "transaction_id long")


@pytest.fixture
def table(spark, tmp_path):
    made = GoldTable(spark, str(tmp_path / "gold"))
    assert made.refresh(*inputs(spark), sources=["a"]) == ["2024-01", "2024-02", "2024-03", "2024-04", NO_MONTH]
    assert made.sources() == ["a"]
    return made, tmp_path / "gold"


def test_only_touched_months_are_written(spark, table):
    made, path = table
    before = files(path)
    assert rows(made.read()) == rows(gold.sales_analytics(*inputs(spark)))
    assert made.refresh(*inputs(spark), changed_sales=ids(spark)) == [] and files(path) == before
    dearer = inputs(spark, prices=(1.0, 5.0, 3.0))
    assert made.refresh(*dearer, changed_sales=ids(spark)) == ["2024-02"]
    assert rows(made.read()) == rows(gold.sales_analytics(*dearer))
    after = files(path)
    assert after.pop("month=2024-02") != before.pop("month=2024-02") and after == before


def test_moved_sales_and_lost_names(spark, table):
    made, path = table
    moved = {**SALES, 3: (1, 3, date(2024, 4, 9))}
    assert made.refresh(*inputs(spark, moved), changed_sales=ids(spark, 3, 3, 7)) == ["2024-03", "2024-04"]
    assert "month=2024-03" not in files(path)
    assert rows(made.read()) == rows(gold.sales_analytics(*inputs(spark, moved)))
    closed = inputs(spark, moved, second=CLOSED)
    assert made.refresh(*closed, changed_sales=ids(spark)) == ["2024-02", "2024-04"]
    assert rows(made.read()) == rows(gold.sales_analytics(*closed)) and "month=2024-02" not in files(path)
    # Not told which sales have changed, it compares all.
    assert made.refresh(*inputs(spark, SALES)) == ["2024-02", "2024-03", "2024-04"]
    assert rows(made.read()) == rows(gold.sales_analytics(*inputs(spark)))


@pytest.mark.parametrize("step", ["_write", "_note"])
def test_months_of_a_refresh_that_died_are_written_by_the_next(spark, table, monkeypatch, step):
    made, _ = table
    own = getattr(GoldTable, step)

    def dies(self, *args):
        if step == "_note" and not args[0]["done"]:
            return own(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(GoldTable, step, dies)
    with pytest.raises(RuntimeError):
        made.refresh(*inputs(spark, prices=(1.0, 5.0, 3.0)), changed_sales=ids(spark))
    monkeypatch.undo()
    # Prices are back: nothing differs from the last finished refresh, but the stored month may.
    assert made.refresh(*inputs(spark), changed_sales=ids(spark)) == ["2024-02"]
    assert rows(made.read()) == rows(gold.sales_analytics(*inputs(spark)))


def test_no_sales(spark, tmp_path):
    made = GoldTable(spark, str(tmp_path / "gold"))
    assert made.refresh(*inputs(spark, {7: SALES[7]})) == []
    assert made.read().count() == 0
