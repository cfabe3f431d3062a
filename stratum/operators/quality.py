"""Data-quality checks: every check is a DataFrame ``(check, subject, key, n, severity)``.

A row reports what was found: counts always, findings only where there are any.  ``enforce``
turns findings of severity ``error`` into an exception.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.ordered import KeyedSequence
from stratum.operators.skew import HOT_ROWS, LOOK, find_hot, find_hot_ranges, no_null, skew_join
from stratum.specs import SPECS

INFO, WARNING, ERROR = "info", "warning", "error"

REPORT = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("severity", T.StringType()),
    ]
)

# The column a staging table must fill, by table; the others use the row id.
STAGING_KEY = {"customers": "customer_id", "salestransactions": "transaction_id"}

# Columns that must be filled in the ingredients silver table.
INGREDIENT_CRITICAL = ("ingredient_id", "name", "valid_from", "active")


def _forever() -> Column:
    return F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")


class QualityError(ValueError):
    """Findings of severity ``error``."""


def _measures(df: DataFrame, subject: str, measures: Mapping[tuple[str, str, str], Column]) -> DataFrame:
    """One pass over ``df`` for many counts, turned into report rows afterwards."""
    cells = [
        F.struct(
            F.lit(check).alias("check"), F.lit(key).alias("key"), n.cast("long").alias("n"), F.lit(level).alias("severity")
        )
        for (check, key, level), n in measures.items()
    ]
    return (
        df.agg(F.array(*cells).alias("cells"))
        .select(F.inline("cells"))
        .select("check", F.lit(subject).alias("subject"), "key", "n", "severity")
    )


def _nulls(columns: Sequence[str]) -> Column:
    return F.count_if(~no_null(columns))


def together(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def row_counts(df: DataFrame, subject: str) -> DataFrame:
    """All rows, and active and inactive rows where the table keeps history."""
    measures = {("rows", "all", INFO): F.count("*")}
    if "active" in df.columns:
        measures[("rows", "active", INFO)] = F.count_if("active")
        measures[("rows", "inactive", INFO)] = F.count_if(~F.col("active"))
    return _measures(df, subject, measures)


def null_staging_key(staging: DataFrame, entity: str) -> DataFrame:
    column = STAGING_KEY.get(entity, "row_id")
    return _measures(staging, entity, {("null_key", column, WARNING): _nulls([column])})


def null_keys(df: DataFrame, subject: str, groups: Sequence[Sequence[str]], *, severity: str = WARNING) -> DataFrame:
    """Rows with a NULL in any column of a group; all groups in one pass."""
    return _measures(df, subject, {("null_key", "+".join(g), severity): _nulls(g) for g in groups})


# The column groups each silver table and the gold view are tested on.
NULL_KEY_GROUPS: dict[str, tuple[tuple[str, ...], ...]] = {
    "customers": (("customer_id",),),
    "provider": (("provider_id",), ("name",)),
    "flavours": (("flavour_id",), ("name",)),
    "rawmaterialtype": (("raw_material_type_id",), ("name",)),
    "ingredientsrawmaterial": (("ingredient_rawmaterial_id",), ("ingredient_id",), ("raw_material_type_id",)),
    "ingredients": (INGREDIENT_CRITICAL,),
    "recipes": (("recipe_id", "flavour_id", "ingredient_id", "quantity_grams"),),
    "stocks": (("stock_id", "flavour_id"),),
    "salestransactions": (("transaction_id",), ("customer_id",)),
    "gold_sales": (("transaction_id",),),
}


def null_critical(ingredients: DataFrame) -> DataFrame:
    return null_keys(ingredients, "ingredients", [INGREDIENT_CRITICAL], severity=ERROR)


def duplicates(
    df: DataFrame, subject: str, keys: Sequence[str], *, active_only: bool = False, severity: str = WARNING
) -> DataFrame:
    """Keys with more than one row (or more than one active row)."""
    rows = df.where("active") if active_only else df
    label = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(
            F.lit("duplicate_active" if active_only else "duplicate").alias("check"),
            F.lit(subject).alias("subject"),
            label.alias("key"),
            "n",
            F.lit(severity).alias("severity"),
        )
    )


def date_order(silver: DataFrame, subject: str, *, severity: str = ERROR) -> DataFrame:
    """Closed versions that end before or when they begin."""
    wrong = ~F.col("active") & (F.col("valid_from") >= F.col("valid_to"))
    return _measures(silver, subject, {("date_order", "valid_from>=valid_to", severity): F.count_if(wrong)})


def unprocessed(staging: DataFrame, entity: str) -> DataFrame:
    """Rows still pending after the merge, with all their business columns."""
    spec = SPECS[entity]
    return staging.where("merge_status = 0").select(
        "row_id", *[spec.staging_column(c) for c in spec.business], "inserted_at"
    )


# --- validity overlap ---------------------------------------------------------------------


def overlap_keys(
    silver: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, look: float = LOOK
) -> DataFrame:
    """Keys with versions that begin before an earlier one has ended, and how many do.

    Current versions count as unending here.  Versions of one key that begin together are grouped first: all
    of them begin too early if an earlier version is still open, else all that outlast their begin but one, the
    last to end.  One window pass over the groups; nothing is joined to itself.
    """
    ends = silver.where(no_null([*keys, "valid_from"])).select(
        *keys, "valid_from", F.coalesce(F.col("valid_to"), _forever()).alias("_end")
    )
    rows = ends.groupBy(*keys, "valid_from").agg(
        F.max("_end").alias("_end"), F.count("*").alias("_all"), F.count_if(F.col("_end") > F.col("valid_from")).alias("_lasting")
    )
    hot = find_hot_ranges(ends, keys, "valid_from", hot_rows, look)
    sequence = KeyedSequence(rows, keys, "valid_from", hot)
    seen = sequence.max_before(sequence.rows, "_end", "_end_before")
    early = F.when(F.col("valid_from") < F.col("_end_before"), F.col("_all")).otherwise(F.greatest(F.col("_lasting") - 1, F.lit(0)))
    return seen.groupBy(*keys).agg(F.sum(early).alias("n")).where("n > 0")


def _rank_sums(marks: DataFrame, groups: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """For points and queries on one time axis per group: ``points``, ``queries`` and
    ``not_after``, the number of (query, point) pairs whose point is not after the query.

    ``marks`` has the group columns, ``at``, ``points`` and ``queries``.
    """
    per_time = marks.groupBy(*groups, "at").agg(F.sum("points").alias("points"), F.sum("queries").alias("queries"))
    sequence = KeyedSequence(per_time, groups, "at", hot)
    ranked = sequence.running_sum(sequence.rows, "points", "_so_far")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return ranked.groupBy(*groups).agg(
        F.sum(wide("points")).alias("points"),
        F.sum(wide("queries")).alias("queries"),
        F.sum(wide("queries") * wide("_so_far")).alias("not_after"),
    )


def overlap_pairs(
    silver: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, look: float = LOOK
) -> DataFrame:
    """Ordered pairs of closed versions of one key that overlap and are not the same interval.

    The pairs are counted, never formed.  Two versions with a proper order of dates fail to
    overlap when one ends by the time the other begins, which a running count along time gives.
    A version whose dates are reversed overlaps those proper versions that enclose it; enclosing
    ones are counted per binary prefix of their begin, again by running counts.
    """
    keys = list(keys)
    closed = silver.where(no_null([*keys, "valid_from", "valid_to"])).select(*keys, "valid_from", "valid_to")
    proper = closed.where("valid_from < valid_to")
    reversed_ = closed.where("valid_from >= valid_to")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    # Proper with proper: all ordered pairs, minus twice those with one over before the other
    # begins, minus the pairs within groups of identical intervals (a version with itself too).
    ends = proper.select(*keys, F.col("valid_to").alias("at"), one.alias("points"), zero.alias("queries"))
    begins = proper.select(*keys, F.col("valid_from").alias("at"), zero.alias("points"), one.alias("queries"))
    marks = ends.unionByName(begins)
    hot = find_hot_ranges(marks, keys, "at", hot_rows, look)
    plain = _rank_sums(marks, keys, hot).select(
        (F.col("points") * F.col("queries") - 2 * F.col("not_after")).cast("decimal(38,0)").alias("n")
    )
    same = (
        proper.groupBy(*keys, "valid_from", "valid_to")
        .agg(F.count("*").cast("decimal(19,0)").alias("_c"))
        .select((-F.col("_c") * F.col("_c")).cast("decimal(38,0)").alias("n"))
    )

    # Reversed with proper: begin before x, end after y.  With begins and x numbered in time order,
    # the begins before x are the disjoint binary prefixes that branch off to the left of x's
    # number, one per bit set in it.
    suspects = proper.join(reversed_.select(*keys).distinct(), keys, "left_semi")
    marks = suspects.select(
        *keys, F.col("valid_from").alias("at"), F.col("valid_to").alias("_other"), F.lit(0).alias("_bit")
    ).unionByName(
        reversed_.select(
            *keys, F.col("valid_to").alias("at"), F.col("valid_from").alias("_other"), F.lit(1).alias("_bit")
        )
    )
    sequence = KeyedSequence(marks.select(*keys, "at").distinct(), keys, "at", hot)
    numbers = sequence.number(sequence.rows, "_at").select(*keys, "at", "_at")
    # A time can only be hot within a hot key.
    hot_times = None if hot is None else find_hot(marks, [*keys, "at"], hot_rows, look)
    numbered = skew_join(marks, numbers, [*keys, "at"], "inner", hot_times)
    most = marks.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(1))).scalar()
    levels = F.explode(F.sequence(F.lit(0), F.ceil(F.log2(most + 1)).cast("int"))).alias("_level")
    prefix = F.expr("shiftright(_at, _level)")
    enters = F.expr("shiftright(_at, _level) & 1") == F.col("_bit")
    prefixes = numbered.select("*", levels).where(enters).select(
        *keys,
        "_level",
        (prefix - F.col("_bit")).alias("_node"),
        F.col("_other").alias("at"),
        (1 - F.col("_bit")).cast("long").alias("points"),
        F.col("_bit").cast("long").alias("queries"),
    )
    groups = [*keys, "_level", "_node"]
    # A prefix can only be hot within a hot key.
    hot_prefixes = None if hot is None else find_hot_ranges(prefixes, groups, "at", hot_rows, look)
    enclosing = _rank_sums(prefixes, groups, hot_prefixes).select(
        (2 * (F.col("points") * F.col("queries") - F.col("not_after"))).cast("decimal(38,0)").alias("n")
    )
    return together([plain, same, enclosing]).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))


def overlaps(silver: DataFrame, subject: str, keys: Sequence[str], *, severity: str = ERROR) -> DataFrame:
    return overlap_pairs(silver, keys).select(
        F.lit("overlap").alias("check"),
        F.lit(subject).alias("subject"),
        F.lit("+".join(keys)).alias("key"),
        "n",
        F.lit(severity).alias("severity"),
    )


# --- per layer ----------------------------------------------------------------------------


def staging_checks(staging: DataFrame, entity: str) -> DataFrame:
    reports = [row_counts(staging, entity), null_staging_key(staging, entity)]
    if entity == "salestransactions":
        reports.append(duplicates(staging, entity, ["transaction_id"]))
    return together(reports)


def silver_checks(silver: DataFrame, entity: str) -> DataFrame:
    """The checks of one silver table; those of ingredients are errors."""
    spec = SPECS[entity]
    keys = list(spec.keys)
    level = ERROR if entity == "ingredients" else WARNING
    reports = [
        row_counts(silver, entity),
        null_keys(silver, entity, NULL_KEY_GROUPS[entity], severity=level),
        duplicates(silver, entity, keys, active_only=spec.style != "E", severity=level),
    ]
    if entity == "ingredients":
        reports += [overlaps(silver, entity, keys), date_order(silver, entity)]
    return together(reports)


def gold_checks(view: DataFrame) -> DataFrame:
    return together(
        [
            row_counts(view, "gold_sales"),
            null_keys(view, "gold_sales", NULL_KEY_GROUPS["gold_sales"]),
            duplicates(view, "gold_sales", ["transaction_id"]),
        ]
    )


def enforce(report: DataFrame) -> None:
    """Raise if the report has findings of severity ``error``.

    The message names the first twenty; the exception's ``report`` has them all, as a DataFrame.
    """
    errors = report.where((F.col("severity") == ERROR) & (F.col("n") > 0))
    found = errors.limit(20).collect()
    if found:
        raised = QualityError("; ".join(f"{r['check']} in {r['subject']} ({r['key']}): {r['n']}" for r in found))
        raised.report = errors
        raise raised
