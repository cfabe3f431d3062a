"""Reading history: facts as of their time, the state at a time, and what changed when.

Versions have key columns, ``valid_from``, ``valid_to`` and attributes.  They hold from ``valid_from`` on and
before ``valid_to``, without end if that is NULL; one that ends when or before it begins never holds.  Of versions
of a key that begin together the one that ends last counts, then the one with the greatest attributes, in
their order, NULL being the least.  Versions with a NULL in the key or in ``valid_from`` are nobody's.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.ordered import KeyedSequence
from stratum.operators.skew import HOT_ROWS, LOOK, find_hot, find_hot_ranges, no_null, skew_join

_TIMES = ("valid_from", "valid_to")


def _forever() -> Column:
    return F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")


def _attributes(versions: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in versions.columns if c not in (*keys, *_TIMES)]


def _begun(versions: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Keys, the begin of a version as ``_at``, and its end and attributes as ``_version``."""
    end = F.coalesce(F.col("valid_to").cast("timestamp_ntz"), _forever()).alias("_end")
    return versions.where(no_null([*keys, "valid_from"])).select(
        *keys, F.col("valid_from").cast("timestamp_ntz").alias("_at"), F.struct(end, *attributes).alias("_version")
    )


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    *,
    prefix: str = "asof_",
    hot_rows: int = HOT_ROWS,
    look: float = LOOK,
) -> DataFrame:
    """``facts`` with the attributes of the version of their key at time ``at``, named with ``prefix``.

    That is the last version that has begun by then, if it still holds; else, and for facts with a NULL in key or
    time, the attributes are NULL.  No fact is lost or repeated.

    Without hot keys versions and facts go through one window along time.  Else begins of versions and the different
    times of facts are grouped per key and time, which combines on the map side, and the last version is carried
    forward along time.  Facts then join their key and time by equality: there is no range join.  A hot key is sliced,
    a hot time of it salted.
    """
    keys, attributes = list(keys), _attributes(versions, keys)
    begun = _begun(versions, keys, attributes)
    times = begun.select(*keys, "_at").unionByName(facts.select(*keys, F.col(at).cast("timestamp_ntz").alias("_at")))
    hot = find_hot_ranges(times.where(no_null([*keys, "_at"])), keys, "_at", hot_rows, look)
    if hot is None:
        return _as_of_window(facts, begun, keys, at, attributes, prefix)
    begun = begun.withColumn("_asked", F.lit(False))
    timed = facts.withColumn("_at", F.col(at).cast("timestamp_ntz"))
    asked = timed.where(no_null([*keys, "_at"])).select(
        *keys, "_at", F.lit(None).cast(begun.schema["_version"].dataType).alias("_version"), F.lit(True).alias("_asked")
    )
    marks = begun.unionByName(asked)
    per_time = marks.groupBy(*keys, "_at").agg(F.max("_version").alias("_version"), F.max("_asked").alias("_asked"))
    sequence = KeyedSequence(per_time, keys, "_at", hot)
    held = sequence.last_known(sequence.rows, F.col("_version"), "_held").where("_asked")
    holds = F.col("_at") < F.col("_held._end")
    lookup = held.select(*keys, "_at", *[F.when(holds, F.col("_held")[c]).alias(f"{prefix}{c}") for c in attributes])
    hot_times = find_hot(timed, [*keys, "_at"], hot_rows, look)
    joined = skew_join(timed, lookup, [*keys, "_at"], "left", hot_times)
    return joined.select(*facts.columns, *[f"{prefix}{c}" for c in attributes])


def _as_of_window(
    facts: DataFrame, begun: DataFrame, keys: Sequence[str], at: str, attributes: Sequence[str], prefix: str
) -> DataFrame:
    """Facts take the greatest of the versions begun by their time, which compare by begin, then end and attributes.

    Facts with a NULL in key or time meet no version; they are spread by their content.
    """
    fact, version, time = F.struct(*facts.columns), F.struct("_at", "_version"), F.col(at).cast("timestamp_ntz")
    known = no_null(keys) & time.isNotNull()
    spread = F.when(known, F.lit(0).cast("long")).otherwise(F.xxhash64(*facts.columns))
    asked = facts.select(*keys, time.alias("_at"), spread.alias("_spread"), fact.alias("_fact"))
    marks = begun.select(*keys, "_at", F.lit(0).cast("long").alias("_spread"), version.alias("_begun")).unionByName(
        asked, allowMissingColumns=True
    )
    so_far = Window.partitionBy(*keys, "_spread").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    held = marks.withColumn("_held", F.max("_begun").over(so_far)).where("_fact IS NOT NULL")
    last = F.col("_held._version")
    holds = F.col("_at") < last["_end"]
    return held.select("_fact.*", *[F.when(holds, last[c]).alias(f"{prefix}{c}") for c in attributes])


def snapshot(versions: DataFrame, at: datetime) -> DataFrame:
    """The versions that hold at a time; all that do, where versions of a key overlap."""
    time = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    return versions.where(
        (F.col("valid_from") <= time) & (F.col("valid_to").isNull() | (F.col("valid_to") > time))
    )


def change_log(
    versions: DataFrame, keys: Sequence[str], *, hot_rows: int = HOT_ROWS, look: float = LOOK
) -> DataFrame:
    """One row per attribute that differs from the version before: keys, ``changed_at``, ``attribute``, both values.

    Values are compared NULL-safely and given as strings.  The order is that of ``valid_from``, whatever the ends
    are; the first version of a key changes nothing.
    """
    keys, attributes = list(keys), _attributes(versions, keys)
    begun = _begun(versions, keys, attributes)
    states = begun.groupBy(*keys, "_at").agg(F.max("_version").alias("_version"))
    sequence = KeyedSequence(states, keys, "_at", find_hot_ranges(begun, keys, "_at", hot_rows, look))
    steps = sequence.previous(sequence.rows, F.col("_version"), "_before").where("_before IS NOT NULL")
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("attribute"),
                F.col("_before")[c].cast("string").alias("old_value"),
                F.col("_version")[c].cast("string").alias("new_value"),
                (~F.col("_before")[c].eqNullSafe(F.col("_version")[c])).alias("_differs"),
            )
            for c in attributes
        ]
    )
    return (
        steps.select(*keys, F.col("_at").alias("changed_at"), F.inline(F.filter(pairs, lambda p: p["_differs"])))
        .drop("_differs")
    )
