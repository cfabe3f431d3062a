"""Column expressions for landing file names and landing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Landing names are <Table>_<yyyymmdd>[_<batch>].csv below landing/<yyyymmdd>/.
_DATE_FORMAT = "yyyyMMdd"
_SUFFIX = r"\.csv$"

# The landing name is the last path part ending in .csv; a delivery written by Spark is a
# folder of that name holding part files.
_LANDING_NAME = r"([^/=]+\.csv)(?:/part-[^/]*)?$"
_DELIVERY = r"^(.*\.csv)/part-[^/]*$"


def landing_name(path: Column) -> Column:
    return F.regexp_extract(path, _LANDING_NAME, 1)


def file_path(path: Column) -> Column:
    """Path in one spelling; the file sources do not agree on local ones."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def delivery_path(path: Column) -> Column:
    """Path of the delivered file, or of the folder its part files lie in."""
    return F.regexp_replace(file_path(path), _DELIVERY, "$1")


def _part(name: Column, index: int) -> Column:
    part = F.get(F.split(F.regexp_replace(name, _SUFFIX, ""), "_"), F.lit(index))
    return F.when(part != "", part)


def table_of(name: Column) -> Column:
    return F.lower(_part(name, 0))


def date_text_of(name: Column) -> Column:
    return _part(name, 1)


def origin_date_of(name: Column) -> Column:
    """Date in the file name; NULL unless it is a real date of eight digits."""
    text = _part(name, 1)
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, _DATE_FORMAT))


def batch_of(name: Column) -> Column:
    """Batch number: 0 if the name has none, NULL if it is not a number."""
    text = _part(name, 2)
    return F.when(text.isNull(), F.lit(0)).otherwise(text.try_cast("int"))


def typed(text: Column, dtype: T.DataType) -> Column:
    """Landing text as its declared type, NULL where it does not fit.

    A whole number may be written with decimals, as exports of columns with gaps do; it is
    rounded then.
    """
    if isinstance(dtype, T.StringType):
        return text
    text = F.trim(text)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        rounded = F.round(text.try_cast("decimal(38,6)"), 0).try_cast(dtype)
        return F.coalesce(text.try_cast(dtype), rounded)
    return text.try_cast(dtype)


def unfit(text: Column, dtype: T.DataType) -> Column:
    """A value is there but does not fit its declared type."""
    if isinstance(dtype, T.StringType):
        return F.lit(False)
    return text.isNotNull() & (F.trim(text) != "") & typed(text, dtype).isNull()
