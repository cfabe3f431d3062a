"""Landing folders written from the given tables, for the ingest queries and tests.

One Spark write per entity makes all its deliveries: the target file name is a partition
column, so every delivery is a folder of part files under the landing name convention.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.plans.given import GivenTables
from stratum.schemas import LANDING
from stratum.sources.workspace import shared_folder


def file_name(title: str, date: Column, batch: Column | None = None) -> Column:
    parts = [F.lit(title), F.date_format(date, "yyyyMMdd")]
    if batch is not None:
        parts.append(batch.cast("string"))
    return F.concat(F.concat_ws("_", *parts), F.lit(".csv"))


def deliver(rows: DataFrame, columns: Sequence[str], name: Column, folder: str) -> None:
    """Write ``columns`` into the deliveries that ``name`` gives for each row."""
    rows.withColumn("file", name).select(*columns, "file").write.mode("append").partitionBy("file").option(
        "header", True
    ).option("escape", '"').csv(folder)


def sales_by_batch(given: GivenTables) -> str:
    """All sales as one delivery per batch of one day; some towns hold a line break, quotes and delimiters."""
    folder = shared_folder(given.spark, "landing")
    name = file_name("SalesTransactions", F.lit("2024-05-06").cast("date"), F.col("batch_value"))
    spelled = F.concat(F.col("town"), F.lit('\n"'), F.col("postal_code"), F.lit('", ,'))
    town = F.when(F.col("town") == "R", spelled).otherwise(F.col("town"))
    rows = given.salestransactions_staging().withColumn("town", town)
    deliver(rows, LANDING["salestransactions"].fieldNames(), name, f"{folder}/20240506")
    return folder


def sales_by_month(given: GivenTables) -> str:
    """All sales as one delivery per month of sale and batch."""
    folder = shared_folder(given.spark, "landing")
    name = file_name("SalesTransactions", F.trunc("transaction_date", "month").cast("date"), F.col("batch_value"))
    rows = given.salestransactions_staging()
    deliver(rows, LANDING["salestransactions"].fieldNames(), name, f"{folder}/20240506")
    return folder


def customer_extracts(given: GivenTables) -> str:
    """Two extracts; the second has its columns in another order and one more of them."""
    folder = shared_folder(given.spark, "landing")
    rows = given.customers_staging().withColumn("index", F.col("row_id")).withColumn("remark", F.lit("extra"))
    columns = LANDING["customers"].fieldNames()
    name = file_name("Customers", F.col("origin_date"), F.col("batch_value"))
    deliver(rows.where("batch_value = 1"), columns, name, f"{folder}/20240506")
    deliver(rows.where("batch_value = 2"), ["remark", *reversed(columns)], name, f"{folder}/20240507")
    return folder


def recipe_extracts(given: GivenTables) -> str:
    """Two extracts of all recipe lines, one per day."""
    folder = shared_folder(given.spark, "landing")
    name = file_name("Recipes", F.col("origin_date"), F.col("batch_value"))
    deliver(given.recipes_staging(), LANDING["recipes"].fieldNames(), name, folder)
    return folder


def stocks_with_faults(given: GivenTables) -> str:
    """All stock lines, one delivery per line number; delivery 3 holds quantities that are no numbers,
    and one date and one batch in the file names are wrong."""
    folder = shared_folder(given.spark, "landing")
    rows = given.stocks_staging()
    batch = F.col("batch_value")
    rows = rows.withColumn(
        "quantity_liters",
        F.when((batch == 3) & (F.col("location") == "A"), F.lit("unknown")).otherwise(F.col("quantity_liters").cast("string")),
    )
    name = (
        F.when(batch == 6, F.lit("Stocks_20241345_6.csv"))
        .when(batch == 7, F.lit("Stocks_20240506_seven.csv"))
        .otherwise(file_name("Stocks", F.lit("2024-05-06").cast("date"), batch))
    )
    deliver(rows, LANDING["stocks"].fieldNames(), name, f"{folder}/20240506")
    return folder


def all_dimensions(given: GivenTables) -> str:
    """Both extracts of some simple-key tables, one delivery each, and one of an unknown table."""
    folder = shared_folder(given.spark, "landing")
    for entity, title in (
        ("provider", "Provider"),
        ("flavours", "Flavours"),
        ("rawmaterialtype", "RawMaterialType"),
        ("ingredients", "Ingredients"),
    ):
        name = file_name(title, F.col("origin_date"), F.col("batch_value"))
        deliver(given.staging(entity), LANDING[entity].fieldNames(), name, f"{folder}/20240506")
    unknown = given.table("events")
    deliver(unknown, ["user_id", "value"], F.lit("Visits_20240506_1.csv"), f"{folder}/20240506")
    return folder
