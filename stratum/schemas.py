"""Declared schemas of the nine entities in each layer.

Identifiers are 64-bit: the landing contract calls them integers, and a
cluster-sized fact outgrows 32 bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ID, _NUM, _STR, _DATE = T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
_TS, _INT, _BOOL = T.TimestampNTZType(), T.IntegerType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# Columns of the landing files, in declared order.
LANDING: dict[str, T.StructType] = {
    "flavours": _struct(("flavour_id", _ID), ("name", _STR), ("description", _STR)),
    "ingredientsrawmaterial": _struct(
        ("ingredient_rawmaterial_id", _ID), ("ingredient_id", _ID), ("raw_material_type_id", _ID)
    ),
    "provider": _struct(
        ("provider_id", _ID), ("name", _STR), ("location_city", _STR), ("location_country", _STR)
    ),
    "rawmaterialtype": _struct(("raw_material_type_id", _ID), ("name", _STR)),
    "salestransactions": _struct(
        ("transaction_id", _ID),
        ("customer_id", _ID),
        ("flavour_id", _ID),
        ("quantity_liters", _NUM),
        ("transaction_date", _DATE),
        ("country", _STR),
        ("town", _STR),
        ("postal_code", _STR),
        ("amount_dollar", _NUM),
    ),
    "ingredients": _struct(
        ("ingredient_id", _ID),
        ("name", _STR),
        ("chemical_formula", _STR),
        ("molecular_weight", _NUM),
        ("cost_per_gram", _NUM),
        ("provider_id", _ID),
    ),
    "recipes": _struct(
        ("recipe_id", _ID),
        ("flavour_id", _ID),
        ("ingredient_id", _ID),
        ("quantity_grams", _NUM),
        ("heat_process", _STR),
    ),
    "customers": _struct(
        ("index", _ID), ("customer_id", _ID), ("name", _STR), ("location_city", _STR), ("location_country", _STR)
    ),
    "stocks": _struct(("stock_id", _ID), ("flavour_id", _ID), ("quantity_liters", _NUM), ("location", _STR)),
}

_LINEAGE = (("inserted_at", _TS), ("batch_value", _INT), ("origin_date", _DATE), ("merge_status", _INT))

# Tail of a history-keeping silver table: half-open validity, NULL valid_to is the current version.
HISTORY_TAIL = _struct(
    ("valid_from", _TS), ("valid_to", _TS), ("active", _BOOL), ("load_timestamp", _TS), ("source_date", _DATE)
)
UPSERT_TAIL = _struct(("load_timestamp", _TS), ("source_date", _DATE))

GOLD_SALES = _struct(
    ("transaction_id", _ID),
    ("customer_id", _ID),
    ("customer_name", _STR),
    ("flavour_id", _ID),
    ("flavour_name", _STR),
    ("quantity_liters", _NUM),
    ("transaction_date", _DATE),
    ("revenue", _NUM),
    ("cost_per_liter", _NUM),
    ("total_cost", _NUM),
    ("profit", _NUM),
)


def staging_name(entity: str) -> str:
    return f"dp_{entity}_staging"


def silver_name(entity: str) -> str:
    return f"dp_{entity}_silver"


def staging_schema(entity: str) -> T.StructType:
    """Row id, the landing columns, then the lineage columns."""
    return T.StructType(
        [T.StructField("row_id", T.LongType())] + LANDING[entity].fields + list(_struct(*_LINEAGE).fields)
    )


def silver_schema(entity: str) -> T.StructType:
    """Business columns under their silver names, then the history or upsert tail."""
    from stratum.specs import SPECS

    spec = SPECS[entity]
    source = {f.name: f.dataType for f in staging_schema(entity).fields}
    business = [T.StructField(c, source[spec.staging_column(c)]) for c in spec.business]
    tail = UPSERT_TAIL if spec.style == "E" else HISTORY_TAIL
    return T.StructType(business + list(tail.fields))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
