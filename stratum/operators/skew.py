"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 2_000_000

# Share of the rows looked at to find such keys.  Which keys are found decides how the work is
# spread and never what comes out, so an estimate is enough; a hot key has 20,000 rows in it.
LOOK = 0.01

# So many keys are treated as hot at most, and a hot key is cut into so many slices at most.
MAX_HOT, MAX_SLICES = 10_000, 500

_SALTS, _SALT = "_salts", "_salt"


def any_null(columns: Sequence[str]) -> Column:
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return test


def no_null(columns: Sequence[str]) -> Column:
    return ~any_null(columns)


def _estimate(rows: DataFrame, keys: Sequence[str], hot_rows: int, look: float) -> DataFrame | None:
    """Hot keys with their estimated ``_n``, as a local table; None if there are none.

    The list is fixed in the plan, so a task that is run again spreads its rows as before.  It holds the
    ``MAX_HOT`` largest keys at most: any other key has less than one row in ``MAX_HOT`` of all, which no longer
    holds a job up.  That bounds what reaches the driver and what is broadcast afterwards.
    """
    seen = rows.sample(fraction=look, seed=7) if look < 1 else rows
    found = seen.groupBy(*keys).agg((F.count("*") / look).alias("_n")).where(F.col("_n") > hot_rows)
    hot = found.orderBy(F.col("_n").desc(), *keys).limit(MAX_HOT).collect()
    return rows.sparkSession.createDataFrame(hot, found.schema) if hot else None


def find_hot(
    rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, look: float = LOOK
) -> DataFrame | None:
    """Hot keys of ``rows`` and the number of salts each one gets, or None."""
    hot = _estimate(rows.select(*keys), keys, hot_rows, look)
    return None if hot is None else hot.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias(_SALTS))


def find_hot_ranges(
    rows: DataFrame, keys: Sequence[str], order: str, hot_rows: int = HOT_ROWS, look: float = LOOK
) -> DataFrame | None:
    """Hot keys of ``rows`` with ``_cuts``, times that divide each into slices of about equal row counts, or None.

    The cuts are quantiles of a timestamp column as the sample has it, so that slices hold equal shares however
    rows crowd in time.  Rows of one time stay together: they are to be grouped before they are sliced.
    """
    narrow = rows.select(*keys, order)
    hot = _estimate(narrow, keys, hot_rows, look)
    if hot is None:
        return None
    seen = narrow.sample(fraction=look, seed=7) if look < 1 else narrow
    own = seen.join(F.broadcast(hot.select(*keys)), list(keys), "left_semi")
    at = F.unix_micros(F.col(order).cast("timestamp"))
    places = [i / MAX_SLICES for i in range(1, MAX_SLICES)]
    sketches = own.groupBy(*keys).agg(F.percentile_approx(at, places, 10 * MAX_SLICES).alias("_quantiles"))
    step = F.greatest(F.floor(F.lit(MAX_SLICES) * hot_rows / F.col("_n")), F.lit(1)).cast("int")
    cuts = F.array_distinct(F.filter("_quantiles", lambda _, i: (i + 1) % F.col("_step") == 0))
    chosen = hot.withColumn("_step", step).join(F.broadcast(sketches), list(keys)).select(*keys, cuts.alias("_cuts"))
    return rows.sparkSession.createDataFrame(chosen.collect(), chosen.schema)  # MAX_HOT rows of MAX_SLICES times at most


def skew_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, hot: DataFrame | None
) -> DataFrame:
    """Join many ``rows`` per key with the few ``lookup`` rows of the key.

    Without hot keys this is a plain join.  Otherwise rows of a hot key get a salt from their
    own content and the lookup rows of that key are repeated once per salt, so the key spreads
    over tasks; every other key has one salt.  Rows with a NULL in the key match nothing and
    are spread freely.  ``how`` must keep or drop ``rows`` only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join does not support {how}")
    keys = list(keys)
    if hot is None:
        return rows.join(lookup, keys, how)
    hot = F.broadcast(hot)
    content = F.xxhash64(*[F.col(c) for c in rows.columns])
    salt = (
        F.when(any_null(keys), F.pmod(content, F.lit(2**31 - 1)))
        .when(F.col(_SALTS).isNotNull(), F.pmod(content, F.col(_SALTS)))
        .otherwise(0)
        .cast("int")
    )
    salted = rows.join(hot, keys, "left").withColumn(_SALT, salt).drop(_SALTS)
    repeats = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
    repeated = lookup.join(hot, keys, "left").withColumn(_SALT, repeats).drop(_SALTS)
    return salted.join(repeated, [*keys, _SALT], how).drop(_SALT)
