"""Staging and silver tables of the nine entities, derived from the given benchmark tables.

Every table is built from whole given tables: silver is the state of day 0, staging holds two
full daily extracts (days 1 and 2) in which some attributes differ.  Which rows are closed,
changed, unseen or without a key follows from business columns, not from ids.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.session import bound_tasks

_DAY0, _NOON0 = "2024-05-05 00:00:00", "2024-05-05 12:00:00"


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def _cases(otherwise: Column, *cases: tuple[Column, Column]) -> Column:
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), otherwise)


# Where silver tables that break the rules have lost a value, as conditions on their other columns.
UNSOUND: dict[str, dict[str, str]] = {
    "customers": {"customer_id": "NOT active"},
    "provider": {"provider_id": "country = 'AFRICA'", "name": "NOT active"},
    "flavours": {"flavour_id": "description = 'ECONOMY'", "name": "NOT active"},
    "rawmaterialtype": {"raw_material_type_id": "NOT active", "name": "active"},
    "ingredientsrawmaterial": {
        "ingredient_rawmaterial_id": "NOT active", "ingredient_id": "ingredient_rawmaterial_id < 1000",
        "raw_material_type_id": "raw_material_type_id = 5",
    },
    "ingredients": {"ingredient_id": "molecular_weight > 30", "name": "cost_per_gram < 1", "valid_from": "NOT active"},
    "recipes": {"flavour_id": "NOT active AND heat_process = 'R'", "quantity_grams": "quantity_grams < 2"},
    "stocks": {"stock_id": "location = 'A'", "flavour_id": "NOT active"},
    "salestransactions": {"transaction_id": "amount_dollar < 1000", "customer_id": "quantity_liters > 45"},
}


class GivenTables:
    """The given tables below one folder and the tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = bound_tasks(spark), folder

    @cache
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- shared pieces --------------------------------------------------------------------

    @cache
    def _located(self, name: str, nation_key: str) -> DataFrame:
        return (
            self.table(name)
            .join(self.table("nation"), F.col(nation_key) == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

    @staticmethod
    def _extracts(rows: DataFrame, key: str) -> DataFrame:
        """Two daily extracts of all rows: ``b`` is the day, ``row_id`` is unique."""
        return rows.withColumn("b", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
            "row_id", (F.col(key) * 10 + F.col("b")).cast("long")
        )

    @staticmethod
    def _daily_lineage() -> list[Column]:
        second = F.col("b") == 2
        return [
            F.when(second, _ts("2024-05-07 00:00:00")).otherwise(_ts("2024-05-06 00:00:00")).alias("inserted_at"),
            F.col("b").alias("batch_value"),
            F.when(second, _date("2024-05-07")).otherwise(_date("2024-05-06")).alias("origin_date"),
            F.lit(0).alias("merge_status"),
        ]

    @staticmethod
    def _day0_tail(active: Column) -> list[Column]:
        return [
            _ts(_DAY0).alias("valid_from"),
            F.when(~active, _ts(_NOON0)).alias("valid_to"),
            active.alias("active"),
            _ts(_DAY0).alias("load_timestamp"),
            _date("2024-05-05").alias("source_date"),
        ]

    @staticmethod
    def _version(column: str) -> Column:
        return F.concat(F.col(column), F.lit("_v"), F.col("b").cast("string"))

    @cache
    def _lines(self, by_order: bool = False) -> DataFrame:
        """``lineitem`` with ``line_id``: its order and line number repeat, the id does not.

        ``by_order`` deals the lines out by order, which serves the numbering and a join with ``orders`` alike.
        """
        lines = self.table("lineitem")
        return self._numbered(lines.repartition("l_orderkey") if by_order else lines)

    @staticmethod
    def _numbered(lines: DataFrame) -> DataFrame:
        repeat = F.row_number().over(
            Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
                "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
            )
        )
        return lines.withColumn("line_repeat", repeat).withColumn(
            "line_id", (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100 + F.col("line_repeat")
        )

    # --- simple keys ----------------------------------------------------------------------

    @cache
    def customers_silver(self) -> DataFrame:
        return self._located("customer", "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            *self._day0_tail(F.col("c_acctbal") >= 0),
        )

    @cache
    def customers_staging(self) -> DataFrame:
        segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
        return self._extracts(self._located("customer", "c_nationkey"), "c_custkey").select(
            "row_id",
            _cases(
                F.col("c_custkey"),
                ((segment == "FURNITURE") & (balance > 9000), -1 - F.col("c_custkey")),
                ((segment == "HOUSEHOLD") & (balance > 9500), F.lit(None).cast("long")),
            ).alias("customer_id"),
            _cases(
                F.col("c_name"),
                (segment == "BUILDING", self._version("c_name")),
                ((segment == "AUTOMOBILE") & (F.col("b") == 2), self._version("c_name")),
            ).alias("name"),
            F.when(~((segment == "MACHINERY") & (F.col("b") == 1)), F.col("n_name")).alias("location_city"),
            F.col("r_name").alias("location_country"),
            *self._daily_lineage(),
        )

    @cache
    def provider_silver(self) -> DataFrame:
        return self._located("supplier", "s_nationkey").select(
            F.col("s_suppkey").alias("provider_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            *self._day0_tail(F.col("s_acctbal") >= 0),
        )

    @cache
    def provider_staging(self) -> DataFrame:
        return self._extracts(self._located("supplier", "s_nationkey"), "s_suppkey").select(
            "row_id",
            F.col("s_suppkey").alias("provider_id"),
            F.col("s_name").alias("name"),
            _cases(F.col("n_name"), (F.col("r_name") == "ASIA", self._version("n_name"))).alias("location_city"),
            F.col("r_name").alias("location_country"),
            *self._daily_lineage(),
        )

    @cache
    def flavours_silver(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("flavour_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
            *self._day0_tail(F.col("p_size") > 5),
        )

    @cache
    def flavours_staging(self) -> DataFrame:
        kind = F.col("p_type")
        return self._extracts(self.table("part"), "p_partkey").select(
            "row_id",
            F.col("p_partkey").alias("flavour_id"),
            F.col("p_name").alias("name"),
            _cases(
                kind,
                (kind == "PROMO", self._version("p_type")),
                ((kind == "LARGE") & (F.col("b") == 2), self._version("p_type")),
            ).alias("description"),
            *self._daily_lineage(),
        )

    @cache
    def rawmaterialtype_silver(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("raw_material_type_id"),
            F.concat_ws(" ", "p_brand", "p_type").alias("name"),
            *self._day0_tail(F.col("p_retailprice") >= 910),
        )

    @cache
    def rawmaterialtype_staging(self) -> DataFrame:
        parts = self.table("part").withColumn("label", F.concat_ws(" ", "p_brand", "p_type"))
        return self._extracts(parts, "p_partkey").select(
            "row_id",
            F.col("p_partkey").alias("raw_material_type_id"),
            _cases(F.col("label"), (F.col("p_type") == "SMALL", self._version("label"))).alias("name"),
            *self._daily_lineage(),
        )

    @cache
    def ingredientsrawmaterial_silver(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("ingredient_rawmaterial_id"),
            F.col("o_custkey").alias("ingredient_id"),
            F.substring("o_orderpriority", 1, 1).cast("long").alias("raw_material_type_id"),
            *self._day0_tail(F.col("o_orderstatus") != "P"),
        )

    @cache
    def ingredientsrawmaterial_staging(self) -> DataFrame:
        kind = F.substring("o_orderpriority", 1, 1).cast("long")
        return self._extracts(self.table("orders"), "o_orderkey").select(
            "row_id",
            F.col("o_orderkey").alias("ingredient_rawmaterial_id"),
            F.col("o_custkey").alias("ingredient_id"),
            _cases(kind, (F.col("o_orderpriority") == "1-URGENT", kind + F.col("b"))).alias("raw_material_type_id"),
            *self._daily_lineage(),
        )

    @staticmethod
    def _ingredient_columns(cost: Column) -> list[Column]:
        return [
            F.col("s_suppkey").alias("ingredient_id"),
            F.col("s_name").alias("name"),
            F.concat(F.lit("F"), F.col("s_nationkey").cast("string")).alias("chemical_formula"),
            (F.col("s_nationkey") + 10).cast("double").alias("molecular_weight"),
            cost.alias("cost_per_gram"),
            F.col("s_nationkey").cast("long").alias("provider_id"),
        ]

    @cache
    def ingredients_silver(self) -> DataFrame:
        return self.table("supplier").select(
            *self._ingredient_columns(F.abs("s_acctbal") / 1000 + 0.01), *self._day0_tail(F.col("s_acctbal") >= 0)
        )

    @cache
    def ingredients_staging(self) -> DataFrame:
        cost = F.abs("s_acctbal") / 1000 + 0.01
        dearer = _cases(cost, (F.col("s_acctbal") > 5000, cost + F.col("b")))
        return self._extracts(self.table("supplier"), "s_suppkey").select(
            "row_id", *self._ingredient_columns(dearer), *self._daily_lineage()
        )

    # --- composite keys -------------------------------------------------------------------

    @cache
    def recipes_silver(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("recipe_id"),
            F.col("l_partkey").alias("flavour_id"),
            F.col("l_suppkey").alias("ingredient_id"),
            F.col("l_quantity").alias("quantity_grams"),
            F.col("l_returnflag").alias("heat_process"),
            *self._day0_tail(F.col("l_linestatus") == "O"),
        )

    @cache
    def recipes_staging(self) -> DataFrame:
        return self._extracts(self._lines(), "line_id").select(
            "row_id",
            F.col("l_orderkey").alias("recipe_id"),
            F.col("l_partkey").alias("flavour_id"),
            F.col("l_suppkey").alias("ingredient_id"),
            _cases(F.col("l_quantity"), (F.col("l_discount") > 0.085, F.col("l_quantity") + 1)).alias("quantity_grams"),
            _cases(
                F.col("l_returnflag"),
                (F.col("l_tax") > 0.065, F.concat(F.lit("X"), F.col("b").cast("string"))),
                (F.col("l_discount") < 0.005, F.lit(None).cast("string")),
            ).alias("heat_process"),
            *self._daily_lineage(),
        )

    def recipes_repeated(self) -> DataFrame:
        """Recipe extracts in which rows with a new process come twice, under ids of their own."""
        times = F.when(F.col("heat_process").startswith("X"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = self.recipes_staging().withColumn("again", F.explode(times))
        return rows.withColumn("row_id", F.col("row_id") * 2 + F.col("again")).drop("again")

    @cache
    def stocks_silver(self) -> DataFrame:
        """Deliveries per stock and flavour as history; a returned last delivery leaves none active."""
        in_time = Window.partitionBy("l_suppkey", "l_partkey").orderBy(
            "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
        )
        rows = self.table("lineitem").withColumn("next_from", F.lead("l_shipdate").over(in_time))
        active = F.col("next_from").isNull() & (F.col("l_returnflag") != "R")
        day_later = F.expr("l_shipdate + INTERVAL '1' DAY")
        return rows.select(
            F.col("l_suppkey").alias("stock_id"),
            F.col("l_partkey").alias("flavour_id"),
            F.col("l_quantity").alias("quantity_liters"),
            F.col("l_returnflag").alias("location"),
            F.col("l_linenumber").alias("batch_value"),
            F.col("l_shipdate").alias("valid_from"),
            F.when(~active, F.coalesce("next_from", day_later)).alias("valid_to"),
            active.alias("active"),
            F.col("l_shipdate").alias("load_timestamp"),
            F.col("l_shipdate").cast("date").alias("source_date"),
        )

    @cache
    def stocks_staging(self) -> DataFrame:
        """The same deliveries counted again 30 days later; open ones have grown by one litre."""
        counted = F.expr("l_shipdate + INTERVAL '30' DAY")
        # What lines are numbered with goes through an exchange, so it holds what is made of the other columns.
        lines = self.table("lineitem").withColumns({
            "flavour_known": (F.col("l_tax") < 0.075) | (F.col("l_discount") < 0.085),
            "quantity_liters": _cases(F.col("l_quantity"), (F.col("l_linestatus") == "O", F.col("l_quantity") + 1)),
            "location": F.when(F.col("l_discount") > 0.005, F.col("l_returnflag")),
        })
        return self._numbered(lines).select(
            F.col("line_id").alias("row_id"),
            F.col("l_suppkey").alias("stock_id"),
            F.when(F.col("flavour_known"), F.col("l_partkey")).alias("flavour_id"),
            "quantity_liters",
            "location",
            counted.alias("inserted_at"),
            F.col("l_linenumber").alias("batch_value"),
            counted.cast("date").alias("origin_date"),
            F.lit(0).alias("merge_status"),
        )

    # --- sales ----------------------------------------------------------------------------

    @cache
    def _sales(self) -> DataFrame:
        return self._lines(by_order=True).join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    @staticmethod
    def _sale_columns(amount: Column) -> list[Column]:
        return [
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("flavour_id"),
            F.col("l_quantity").alias("quantity_liters"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            F.col("l_linestatus").alias("country"),
            F.col("l_returnflag").alias("town"),
            F.concat("l_returnflag", "l_linestatus").alias("postal_code"),
            amount.alias("amount_dollar"),
        ]

    @cache
    def salestransactions_staging(self) -> DataFrame:
        return self._sales().select(
            F.col("line_id").alias("row_id"),
            *self._sale_columns(F.col("l_extendedprice")),
            F.col("l_shipdate").alias("inserted_at"),
            (F.col("l_suppkey") % 3).cast("int").alias("batch_value"),
            F.col("l_shipdate").cast("date").alias("origin_date"),
            F.lit(0).alias("merge_status"),
        )

    @cache
    def salestransactions_silver(self) -> DataFrame:
        """Sales of finished orders are known already, at half their price."""
        known = self._sales().where("line_repeat = 1 AND o_orderstatus = 'F'")
        return known.select(
            *self._sale_columns(F.col("l_extendedprice") / 2),
            _ts("1990-01-01 00:00:00").alias("load_timestamp"),
            _date("1990-01-01").alias("source_date"),
        )

    # --- history of a dimension -------------------------------------------------------------

    @cache
    def flavour_history(self) -> DataFrame:
        """Deliveries of a flavour as versions of where it comes from; several may begin together, some attributes
        are NULL, and returned ones end a day before they begin."""
        following = F.lead("l_shipdate").over(Window.partitionBy("l_partkey").orderBy("l_shipdate", "line_id"))
        rows = self._lines().withColumn("following", following)
        return rows.select(
            F.col("l_partkey").alias("flavour_id"),
            F.col("l_shipdate").alias("valid_from"),
            _cases(
                F.col("following"), (F.col("l_returnflag") == "R", F.expr("l_shipdate - INTERVAL '1' DAY"))
            ).alias("valid_to"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").alias("quantity_liters"),
            F.when(F.col("l_discount") > 0.02, F.col("l_linestatus")).alias("location"),
        )

    def silver(self, entity: str) -> DataFrame:
        return getattr(self, f"{entity}_silver")()

    def unsound(self, entity: str) -> DataFrame:
        """A silver table that has lost keys and other values that must be there."""
        return self.silver(entity).withColumns(
            {c: F.when(F.expr(f"COALESCE({lost}, FALSE)"), None).otherwise(F.col(c)) for c, lost in UNSOUND[entity].items()}
        )

    def staging(self, entity: str) -> DataFrame:
        return getattr(self, f"{entity}_staging")()

    # --- validity history for the overlap and date-order checks ----------------------------

    @cache
    def user_history(self) -> DataFrame:
        """Each user's events as versions; purchases end an hour late, errors end before they begin."""
        following = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
        kind = F.col("event_type")
        return self.table("events").withColumn("following", following).select(
            "user_id",
            F.col("ts").alias("valid_from"),
            _cases(
                F.col("following"),
                (kind == "purchase", F.expr("following + INTERVAL '1' HOUR")),
                (kind == "error", F.expr("ts - INTERVAL '1' HOUR")),
            ).alias("valid_to"),
            _cases(F.col("following").isNull(), (kind == "error", F.lit(False))).alias("active"),
        )
