"""Cost and profit per sales transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.money import cents, exact
from stratum.operators.skew import HOT_ROWS, LOOK, find_hot, skew_join

#: What a gold row takes from its sale.
SALE = ("transaction_id", "customer_id", "flavour_id", "quantity_liters", "transaction_date", "amount_dollar")


def cost_per_flavour(recipes: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Average cost of a gram of each flavour, weighted by quantity, rounded to cents.

    Quantities are summed per flavour and ingredient before ingredients are joined, so an
    ingredient used everywhere sends one row per flavour and task instead of all its lines.
    """
    grams = (
        recipes.where("active")
        .groupBy("flavour_id", "ingredient_id")
        .agg(F.sum(F.col("quantity_grams").cast("decimal(28,6)")).alias("grams"))
    )
    prices = ingredients.where("active").select("ingredient_id", F.col("cost_per_gram").alias("price"))
    joined = grams.join(prices, "ingredient_id")
    # Products are exact as long as they fit into 38 digits.  A flavour with larger sums is averaged in
    # doubles, which then are good to far less than a cent.
    exact_grams, exact_price = F.expr("try_cast(grams AS DECIMAL(20,6))"), F.expr("try_cast(price AS DECIMAL(17,6))")
    fits = exact_grams.isNotNull() & (exact_price.isNotNull() | F.col("price").isNull())
    wide = F.col("grams").cast("double")
    total = joined.groupBy("flavour_id").agg(
        F.try_sum(exact_grams * exact_price).alias("cost"),
        # A missing price leaves the cost but not the quantity out of the average.
        F.try_sum(exact_grams).alias("grams"),
        F.sum(wide * F.col("price")).alias("wide_cost"),
        F.sum(wide).alias("wide_grams"),
        F.bool_and(fits).alias("fits"),
    )
    average = F.expr("try_cast(try_divide(cost, grams) AS DECIMAL(18,6))")
    rough = F.expr("try_cast(try_divide(wide_cost, wide_grams) AS DECIMAL(18,6))")
    return total.select("flavour_id", cents(F.when(F.col("fits"), average).otherwise(rough)).alias("cost_per_liter"))


def customer_names(customers: DataFrame) -> DataFrame:
    """``customer_id, customer_name`` of active customers."""
    return customers.where("active").select("customer_id", F.col("name").alias("customer_name")).distinct()


def priced_flavours(flavours: DataFrame, recipes: DataFrame, ingredients: DataFrame) -> DataFrame:
    """``flavour_id, flavour_name, cost_per_liter`` of active flavours that have a cost row."""
    named = flavours.where("active").select("flavour_id", F.col("name").alias("flavour_name")).distinct()
    return named.join(cost_per_flavour(recipes, ingredients), "flavour_id")


def sales_analytics(
    sales: DataFrame,
    customers: DataFrame,
    flavours: DataFrame,
    recipes: DataFrame,
    ingredients: DataFrame,
    *,
    unique_sales: bool = True,
    sales_keys: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    look: float = LOOK,
) -> DataFrame:
    """Sales with an active customer, an active flavour and a cost; others are left out.

    Rows are distinct.  Every output column comes from the sale, the customer's name or the
    flavour's name and cost, so making those inputs distinct makes the result distinct and the
    wide result needs no shuffle of its own.  ``unique_sales`` says that the sales hold one row
    per transaction, as silver does.  Flavour names and costs are joined first: sales then meet
    two lookups instead of three.  Hot customers and flavours are looked for in ``sales_keys``,
    stored rows distributed like ``sales``, so that ``sales`` need not be computed for it.
    """
    return priced_sales(
        sales, customer_names(customers), priced_flavours(flavours, recipes, ingredients), unique_sales=unique_sales,
        sales_keys=sales_keys, hot_rows=hot_rows, look=look,
    )


def hot_keys(sales: DataFrame, hot_rows: int = HOT_ROWS, look: float = LOOK) -> tuple[DataFrame | None, DataFrame | None]:
    """Flavours and customers with very many sales."""
    return find_hot(sales, ["flavour_id"], hot_rows, look), find_hot(sales, ["customer_id"], hot_rows, look)


def priced_sales(
    sales: DataFrame,
    names: DataFrame,
    priced: DataFrame,
    *,
    unique_sales: bool = True,
    sales_keys: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    look: float = LOOK,
    hot: tuple[DataFrame | None, DataFrame | None] | None = None,
) -> DataFrame:
    """Sales joined with ``customer_names`` and ``priced_flavours``; ``hot`` gives their ``hot_keys`` if known."""
    fact = sales.select(*SALE)
    if not unique_sales:
        fact = fact.distinct()
    hot_flavours, hot_customers = hot or hot_keys(sales if sales_keys is None else sales_keys, hot_rows, look)
    joined = skew_join(fact, priced, ["flavour_id"], "inner", hot_flavours)
    joined = skew_join(joined, names, ["customer_id"], "inner", hot_customers)
    cost = exact("quantity_liters") * F.col("cost_per_liter")
    return joined.select(
        "transaction_id",
        "customer_id",
        "customer_name",
        "flavour_id",
        "flavour_name",
        "quantity_liters",
        "transaction_date",
        F.col("amount_dollar").alias("revenue"),
        F.col("cost_per_liter").cast("double").alias("cost_per_liter"),
        cents(cost).cast("double").alias("total_cost"),
        cents(exact("amount_dollar") - cost).cast("double").alias("profit"),
    )


def create_view(sales_view: DataFrame, name: str = "vw_salestransaction_analytics") -> None:
    """Register the gold query under its view name; it is computed when read."""
    sales_view.createOrReplaceTempView(name)


def by_month(sales_view: DataFrame) -> DataFrame:
    """The view with its ``month``, dealt out by ranges of date and id, so that a month spreads over as many files as its
    size asks for, and ordered by them inside each."""
    month = F.date_format("transaction_date", "yyyy-MM").alias("month")
    rows = sales_view.select("*", month).repartitionByRange("month", "transaction_date", "transaction_id")
    return rows.sortWithinPartitions("month", "transaction_date", "transaction_id")


def write_by_month(sales_view: DataFrame, path: str) -> None:
    """Write the view below ``path``, one folder per month of ``transaction_date``, ordered by date and id."""
    by_month(sales_view).write.partitionBy("month").parquet(path)
