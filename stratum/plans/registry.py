"""Every registered query: ``(spark, folder of given tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import landing as lf
from stratum.operators import dedupe, gold, history, quality, scd1, scd2, scd2_clean
from stratum.plans import deliveries
from stratum.plans.given import GivenTables
from stratum.plans.layers import Layers
from stratum.schemas import LANDING, staging_name
from stratum.sources import landing
from stratum.sources.gold_table import GoldTable
from stratum.sources.workspace import shared_folder, stored
from stratum.specs import HISTORY_ENTITIES, SPECS

Query = Callable[[SparkSession, str], DataFrame]

LOADED_AT = datetime(2024, 5, 8, 6, 0, 0)
SNAPSHOT_AT = datetime(1996, 7, 1)


def _on(build: Callable[[GivenTables], DataFrame]) -> Query:
    return lambda spark, folder: build(GivenTables(spark, folder))


# --- silver ---------------------------------------------------------------------------------


def literal(given: GivenTables, entity: str, staging: DataFrame | None = None) -> scd2.LiteralMerge:
    silver = given.silver(entity)
    active, _ = scd2.split_history(silver)
    pending = given.staging(entity) if staging is None else staging
    return scd2.LiteralMerge(SPECS[entity], active, pending, active_keys=silver)


def merged(given: GivenTables, entity: str) -> DataFrame:
    return scd2.merge(SPECS[entity], given.silver(entity), given.staging(entity))


def merged_clean(given: GivenTables, entity: str) -> DataFrame:
    silver, staging = given.silver(entity), given.staging(entity)
    if entity == "stocks":
        # Both are made of windows over all lines.  Stored, as in the layers, they leave no shuffles beside those of the merge.
        store = shared_folder(given.spark, "stocks")
        silver, staging = stored(silver, f"{store}/silver"), stored(staging, f"{store}/staging")
    return scd2_clean.merge(SPECS[entity], silver, staging)


def upserted(given: GivenTables) -> DataFrame:
    return scd1.upsert(given.salestransactions_silver(), given.salestransactions_staging())


def latest(given: GivenTables, entity: str) -> DataFrame:
    spec = SPECS[entity]
    rows = dedupe.latest_by_load_time(given.staging(entity), spec.keys)
    return rows.select("row_id", *spec.business, "inserted_at")


def not_in(given: GivenTables) -> DataFrame:
    """Pending customers NOT IN the active ones, by the null rule of NOT IN, without broadcasting silver."""
    merge = literal(given, "customers")
    rows = merge.decided.where("_unseen").select("row_id", "customer_id", "inserted_at")
    return rows.unionByName(merge.keyless.select("row_id", "customer_id", "inserted_at"))


def changed_null_safe(given: GivenTables) -> DataFrame:
    spec = SPECS["customers"]
    active, _ = scd2.split_history(given.customers_silver())
    rows = scd2.to_silver_names(spec, dedupe.pending(given.customers_staging()))
    return scd2.changed_pairs(spec, active, rows, null_safe=True).select("row_id", "customer_id")


def gold_sales(given: GivenTables) -> DataFrame:
    return gold.sales_analytics(
        upserted(given),
        given.customers_silver(),
        given.flavours_silver(),
        given.recipes_silver(),
        given.ingredients_silver(),
        sales_keys=given.salestransactions_staging(),
    )


def gold_refreshed(given: GivenTables) -> DataFrame:
    """Stored gold of day 0, refreshed after the merge of ingredients has changed costs and the upsert sales."""
    table, store = GoldTable(given.spark, shared_folder(given.spark, "gold")), shared_folder(given.spark, "silver")
    names, recipes = (given.customers_silver(), given.flavours_silver()), given.recipes_silver()
    # A refresh reads its inputs several times, so each is computed once, as it is in the layers.
    before = stored(given.salestransactions_silver(), f"{store}/day0")
    table.refresh(before, *names, recipes, given.ingredients_silver())
    staging = stored(given.salestransactions_staging(), f"{store}/staging")
    after = stored(scd1.upsert(before, staging), f"{store}/day1")
    pending = dedupe.pending(staging).select("transaction_id")
    table.refresh(after, *names, recipes, merged(given, "ingredients"), changed_sales=pending)
    return table.read()


def _silver_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "gold_sales_analytics": _on(gold_sales),
        "gold_refreshed": _on(gold_refreshed),
        "gold_cost_per_flavour": _on(
            lambda g: gold.cost_per_flavour(g.recipes_silver(), g.ingredients_silver()).withColumn(
                "cost_per_liter", F.col("cost_per_liter").cast("double")
            )
        ),
        "dedupe_latest_sales": _on(lambda g: scd1.winners(g.salestransactions_staging())),
        "dedupe_latest_ingredients": _on(lambda g: latest(g, "ingredients")),
        "dedupe_latest_recipes": _on(lambda g: latest(g, "recipes")),
        "scd1_insert_sales": _on(
            lambda g: scd1.inserts(g.salestransactions_silver(), g.salestransactions_staging())
        ),
        "scd1_update_sales": _on(
            lambda g: scd1.updates(g.salestransactions_silver(), g.salestransactions_staging())
        ),
        "scd1_upsert_sales": _on(upserted),
        "mark_processed_sales": _on(
            lambda g: scd1.mark_processed(g.salestransactions_staging()).select("row_id", "merge_status")
        ),
        "antijoin_not_in": _on(not_in),
        "scd2_changed_nullsafe": _on(changed_null_safe),
        "scd2_unchanged_stocks": _on(lambda g: literal(g, "stocks").unchanged()),
        "scd2_merge_clean": _on(lambda g: merged_clean(g, "customers")),
    }
    for e in HISTORY_ENTITIES:
        out[f"scd2_new_{e}"] = _on(lambda g, e=e: literal(g, e).new_rows())
        out[f"scd2_changed_{e}"] = _on(lambda g, e=e: literal(g, e).changed())
        out[f"scd2_close_{e}"] = _on(lambda g, e=e: literal(g, e).closed())
        out[f"scd2_versions_{e}"] = _on(lambda g, e=e: literal(g, e).versions())
        out[f"scd2_merge_{e}"] = _on(lambda g, e=e: merged(g, e))
        out[f"mark_processed_{e}"] = _on(lambda g, e=e: literal(g, e).marked().select("row_id", "merge_status"))
        if e != "customers":
            out[f"scd2_merge_clean_{e}"] = _on(lambda g, e=e: merged_clean(g, e))
    return out


# --- quality --------------------------------------------------------------------------------


def row_counts(g: GivenTables) -> DataFrame:
    reports = [quality.row_counts(g.staging(e), f"{e}_staging") for e in SPECS]
    return quality.together(reports + [quality.row_counts(g.silver(e), f"{e}_silver") for e in SPECS])


def null_keys(g: GivenTables) -> DataFrame:
    reports = [
        quality.null_keys(
            g.unsound(e),
            e,
            quality.NULL_KEY_GROUPS[e],
            severity=quality.ERROR if e == "ingredients" else quality.WARNING,
        )
        for e in SPECS
    ]
    reports.append(quality.null_keys(gold_sales(g), "gold_sales", quality.NULL_KEY_GROUPS["gold_sales"]))
    return quality.together(reports)


def duplicate_transactions(g: GivenTables) -> DataFrame:
    layers = {"staging": g.salestransactions_staging(), "silver": upserted(g), "gold": gold_sales(g)}
    return quality.together([quality.duplicates(df, layer, ["transaction_id"]) for layer, df in layers.items()])


def after_repeats(g: GivenTables, entity: str) -> DataFrame:
    """What the literal merge leaves active, and what it has closed; what was closed before cannot be active twice.

    Changed recipes came twice in one load, as else none would be active twice.
    """
    return literal(g, entity, g.recipes_repeated() if entity == "recipes" else None).delta()


def _quality_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "dq_row_counts": _on(row_counts),
        "dq_null_staging": _on(
            lambda g: quality.together([quality.null_staging_key(g.staging(e), e) for e in SPECS])
        ),
        "dq_null_keys": _on(null_keys),
        "dq_null_critical": _on(lambda g: quality.null_critical(g.unsound("ingredients"))),
        "dq_duplicate_transactions": _on(duplicate_transactions),
        "dq_overlap_pairs": _on(lambda g: quality.overlap_pairs(g.user_history(), ["user_id"])),
        "dq_overlap_keys": _on(lambda g: quality.overlap_keys(g.user_history(), ["user_id"])),
        "dq_date_order": _on(lambda g: quality.date_order(g.user_history(), "user_history")),
    }
    for e in HISTORY_ENTITIES:
        out[f"dq_duplicate_active_{e}"] = _on(
            lambda g, e=e: quality.duplicates(after_repeats(g, e), e, list(SPECS[e].keys), active_only=True)
        )
    for e in ("recipes", "stocks"):
        out[f"dq_unprocessed_{e}"] = _on(lambda g, e=e: quality.unprocessed(literal(g, e).marked(), e))
    return out


# --- history --------------------------------------------------------------------------------


def asof_sales(g: GivenTables) -> DataFrame:
    """Where the flavour of each sale came from on the day of the sale."""
    sales = g.salestransactions_staging().select("row_id", "transaction_id", "flavour_id", "transaction_date")
    return history.as_of(sales, g.flavour_history(), ["flavour_id"], "transaction_date")


def _history_queries() -> dict[str, Query]:
    return {
        "history_asof_sales": _on(asof_sales),
        "history_snapshot": _on(lambda g: history.snapshot(g.stocks_silver(), SNAPSHOT_AT)),
        "history_change_log": _on(lambda g: history.change_log(g.flavour_history(), ["flavour_id"])),
    }


# --- bronze ---------------------------------------------------------------------------------


def file_manifest(g: GivenTables) -> DataFrame:
    found = landing.manifest(landing.list_files(g.spark, deliveries.sales_by_month(g)))
    return found.select("file_name", "table_name", "staging_table", "origin_date", "batch_value", "reason")


def parse_filename(g: GivenTables) -> DataFrame:
    """File names of all forms built from every order, and their parts."""
    day, batch = F.date_format("o_orderdate", "yyyyMMdd"), F.substring("o_orderpriority", 1, 1)
    name = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Stocks_"), day, F.lit("_"), batch, F.lit(".csv")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("Recipes_"), day, F.lit(".csv")))
        .otherwise(F.lit("Customers.csv"))
    )
    named = g.table("orders").select("o_orderkey", name.alias("file_name"))
    return landing.parse_names(named, F.col("file_name"))


def missing_tables(g: GivenTables) -> DataFrame:
    found = landing.manifest(landing.list_files(g.spark, deliveries.all_dimensions(g)))
    return landing.missing_tables(found, [staging_name("flavours")])


def _raw(g: GivenTables, folder: str, entity: str) -> tuple[DataFrame, list[landing.Delivery]]:
    found = landing.probe(g.spark, landing.manifest(landing.list_files(g.spark, folder)), entity)
    return landing.scan(g.spark, entity, found), found


def csv_scan(g: GivenTables) -> DataFrame:
    """Towns hold quotes, delimiters and line breaks."""
    found = landing.probe(g.spark, landing.manifest(landing.list_files(g.spark, deliveries.sales_by_batch(g))), "salestransactions")
    large = any(d.largest > landing.WHOLE_FILE for d in found)
    rows = landing.read_typed(g.spark, "salestransactions", found, shared_folder(g.spark, "parsed") if large else None)
    return rows.select(*LANDING["salestransactions"].fieldNames())


def lineage(g: GivenTables) -> DataFrame:
    raw, found = _raw(g, deliveries.customer_extracts(g), "customers")
    return landing.with_lineage(landing.reject_bad(raw, "customers", deliveries=len(found)), "customers", LOADED_AT)


def rejected_files(g: GivenTables) -> DataFrame:
    found = landing.manifest(landing.list_files(g.spark, deliveries.stocks_with_faults(g)))
    rejects = landing.load(g.spark, found, "stocks", LOADED_AT).rejects
    return rejects.select(lf.landing_name(F.col("delivery")).alias("file_name"), "reason")


def accepted_rows(g: GivenTables) -> DataFrame:
    found = landing.manifest(landing.list_files(g.spark, deliveries.stocks_with_faults(g)))
    return landing.load(g.spark, found, "stocks", LOADED_AT).rows.drop("row_id")


def row_ids(g: GivenTables) -> DataFrame:
    found = landing.manifest(landing.list_files(g.spark, deliveries.sales_by_batch(g)))
    rows = landing.load(g.spark, found, "salestransactions", LOADED_AT, numbered=shared_folder(g.spark, "numbered")).rows
    return rows.agg(
        F.count("*").alias("n"), F.count_distinct("row_id").alias("distinct_ids"), F.min("row_id").alias("first_id"),
        F.max("row_id").alias("last_id"),
    )


def appended(g: GivenTables) -> DataFrame:
    """Two recipe loads appended one after the other; ids go on above those already there."""
    source, store = deliveries.recipe_extracts(g), shared_folder(g.spark, "staging")
    found = landing.manifest(landing.list_files(g.spark, source))
    first, second = (found.where(F.col("batch_value") == b) for b in (1, 2))
    landing.append(landing.load(g.spark, first, "recipes", LOADED_AT).rows, store, "recipes")
    existing = landing.read_staging(g.spark, store, "recipes")
    landing.append(landing.load(g.spark, second, "recipes", LOADED_AT, existing).rows, store, "recipes")
    return (
        landing.read_staging(g.spark, store, "recipes")
        .groupBy("origin_date", "batch_value", "merge_status")
        .agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("distinct_ids"))
    )


# --- landing to silver on stored tables -----------------------------------------------------


def _through_layers(g: GivenTables, folder: str, entity: str) -> DataFrame:
    """Silver of one entity after its deliveries were loaded and merged one batch after the other."""
    layers = Layers(g.spark, shared_folder(g.spark, "store"))
    found = landing.manifest(landing.list_files(g.spark, folder))
    batches = sorted(r.batch_value for r in found.select("batch_value").distinct().collect())  # two or three
    for i, batch in enumerate(batches):
        layers.ingest(found.where(F.col("batch_value") == batch), LOADED_AT + timedelta(days=i), f"batch {batch}")
        layers.merge(entity, f"batch {batch}")
    return layers.silver(entity)


def layers_sales(g: GivenTables) -> DataFrame:
    """Which load has the say on each transaction; rows of one delivery that tie may have other amounts."""
    rows = _through_layers(g, deliveries.sales_by_batch(g), "salestransactions")
    return rows.select("transaction_id", "customer_id", "transaction_date", "load_timestamp", "source_date")


def _layer_queries() -> dict[str, Query]:
    return {
        "layers_customer_history": _on(lambda g: _through_layers(g, deliveries.customer_extracts(g), "customers")),
        "layers_upserted_sales": _on(layers_sales),
    }


def _bronze_queries() -> dict[str, Query]:
    return {
        "bronze_file_manifest": _on(file_manifest),
        "bronze_parse_filename": _on(parse_filename),
        "bronze_missing_tables": _on(missing_tables),
        "bronze_csv_scan": _on(csv_scan),
        "bronze_lineage": _on(lineage),
        "bronze_reject_bad_files": _on(rejected_files),
        "bronze_accepted_rows": _on(accepted_rows),
        "bronze_row_id": _on(row_ids),
        "bronze_append": _on(appended),
    }


def all_queries() -> dict[str, Query]:
    return _silver_queries() | _quality_queries() | _history_queries() | _bronze_queries() | _layer_queries()
