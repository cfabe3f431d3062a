"""The gold view as a stored table by month of sale, refreshed where its inputs have changed.

    <path>/month=<yyyy-MM>        gold rows; months that no change touches keep their files
    <path>/_refresh/log           one row when a refresh begins to write and one when it is done
    <path>/_refresh/<refresh>     names and costs that the refresh joined; while it runs, also rows between its steps

One writer per table.  While months are overwritten, readers may see some before and some after the change.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators import gold
from stratum.schemas import GOLD_SALES
from stratum.session import bound_tasks
from stratum.sources.workspace import shuffles_removed, stored

#: Where sales without a date go, as partitions of null are called.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"

_NAMES = T.ArrayType(T.StringType())
_LOG = T.StructType(
    [
        T.StructField("turn", T.LongType()),
        T.StructField("refresh", T.StringType()),
        T.StructField("done", T.BooleanType()),
        T.StructField("months", _NAMES),
        T.StructField("sources", _NAMES),
    ]
)


def differing(then: DataFrame, now: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other; NULLs are equal."""
    counted = now.withColumn("_n", F.lit(1)).unionByName(then.select(*now.columns, F.lit(-1).alias("_n")))
    return counted.groupBy(*now.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").drop("_n")


def _month() -> Column:
    return F.coalesce(F.date_format("transaction_date", "yyyy-MM"), F.lit(NO_MONTH))


class GoldTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = bound_tasks(spark), path.rstrip("/")

    def read(self) -> DataFrame:
        """All gold rows."""
        schema = T.StructType([*GOLD_SALES.fields, T.StructField("month", T.StringType())])
        return self.spark.read.schema(schema).parquet(self.path).drop("month")

    def sources(self) -> list[str]:
        """What the last finished refresh was told its sales come from."""
        return list(self._finished().sources)

    def refresh(
        self,
        sales: DataFrame,
        customers: DataFrame,
        flavours: DataFrame,
        recipes: DataFrame,
        ingredients: DataFrame,
        *,
        changed_sales: DataFrame | None = None,
        sources: Iterable[str] = (),
    ) -> list[str]:
        """Bring the table up to its inputs, silver rows with one sale per transaction; returns the months written.

        Customers whose active names, and flavours whose names or costs, differ from those of the last refresh, and
        ``changed_sales`` (``transaction_id`` of those that may have changed; None: all may) tell which sales to look at.
        Their gold rows are compared with the stored ones, and months that hold a difference are written again from all
        their sales.  The months are logged first, so those of a refresh that died are written by the next one.
        Each step's rows are stored, so that the disk holds what one step shuffles and not what all do.
        """
        with shuffles_removed(self.spark):
            return self._refresh(sales, customers, flavours, recipes, ingredients, changed_sales, sources)

    def _refresh(
        self,
        sales: DataFrame,
        customers: DataFrame,
        flavours: DataFrame,
        recipes: DataFrame,
        ingredients: DataFrame,
        changed_sales: DataFrame | None,
        sources: Iterable[str],
    ) -> list[str]:
        log, last = self._log(), self._finished()
        folder = f"{self.path}/_refresh/{uuid.uuid4().hex[:12]}"
        names = stored(gold.customer_names(customers), f"{folder}/customers")
        priced = stored(gold.priced_flavours(flavours, recipes, ingredients), f"{folder}/flavours")
        hot = gold.hot_keys(sales)
        star = lambda rows: gold.priced_sales(rows, names, priced, hot=hot)
        if last.turn:
            then = f"{self.path}/_refresh/{last.refresh}"
            marks = {
                "customer_id": differing(self.spark.read.schema(names.schema).parquet(f"{then}/customers"), names),
                "flavour_id": differing(self.spark.read.schema(priced.schema).parquet(f"{then}/flavours"), priced),
            }
            looked_at, old = sales, self.read()
            if changed_sales is not None:
                keys = {k: rows.select(k).distinct() for k, rows in (marks | {"transaction_id": changed_sales}).items()}
                looked_at = stored(_with_any(sales.select(*gold.SALE), keys), f"{folder}/steps/sales")
                old = stored(_with_any(old, keys), f"{folder}/steps/old")
            changed = differing(old, stored(star(looked_at), f"{folder}/steps/new"))
        else:
            changed = stored(star(sales), f"{folder}/steps/all")
        months = {r.month for r in changed.select(_month().alias("month")).distinct().collect()}  # one per month
        if last.turn:
            self._remove(f"{folder.removeprefix(self.path + '/')}/steps")
        unfinished = log.where((F.col("turn") > last.turn) & ~F.col("done"))
        months |= {r.month for r in unfinished.select(F.explode("months").alias("month")).distinct().collect()}
        turn, name = (log.agg(F.max("turn")).first()[0] or 0) + 1, folder.rpartition("/")[2]
        entry = {"turn": turn, "refresh": name, "months": sorted(months), "sources": sorted(sources)}
        if months:
            self._note(entry | {"done": False})
            fresh = stored(star(sales.where(_month().isin(*months))), f"{folder}/steps/fresh") if last.turn else changed
            self._write(fresh)
            if entry["turn"] > 1:
                # Months without rows have not been overwritten.
                held = {r.month for r in fresh.select(_month().alias("month")).distinct().collect()}
                for month in sorted(months - held):
                    self._remove(f"month={month}")
        self._note(entry | {"done": True})
        self._remove(f"_refresh/{name}/steps")
        if last.turn:
            self._remove(f"_refresh/{last.refresh}")
        return sorted(months)

    def _write(self, rows: DataFrame) -> None:
        """Replace the months of ``rows``, which are all rows of these."""
        gold.by_month(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(self.path)

    # --- log ------------------------------------------------------------------------------

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/_refresh/log")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def _finished(self) -> T.Row:
        newest = self._log().where("done").orderBy(F.col("turn").desc()).limit(1).collect()
        return newest[0] if newest else T.Row(turn=0, refresh=None, done=True, months=[], sources=[])

    def _note(self, entry: dict) -> None:
        row = self.spark.createDataFrame([tuple(entry[f.name] for f in _LOG)], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/_refresh/log")

    def _remove(self, name: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def _with_any(rows: DataFrame, keys: dict[str, DataFrame]) -> DataFrame:
    """Rows that have one of the listed keys in any of its columns; each list has a key once."""
    marked = rows
    for column, listed in keys.items():
        marked = marked.join(listed.withColumn(f"_has_{column}", F.lit(True)), column, "left")
    return marked.where(F.coalesce(*[f"_has_{c}" for c in keys])).select(*rows.columns)
