"""Neighbours and running totals along time, per key, when one key may hold most of the rows.

Without hot keys these are plain windows.  A hot key is cut into time slices with about the same
number of rows: windows are partitioned by key *and* slice, and what a slice needs from the slices
before or after it travels in a summary with one row per slice of a hot key, which the rows join
where they are.  Rows of one key and time are never divided, so callers bring one row, or a few, of
each: many that tie are to be grouped beforehand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_SLICE = "_slice"


class KeyedSequence:
    """Rows per key in the order of one timestamp column; ``hot`` is from ``find_hot_ranges``."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], order: str, hot: DataFrame | None):
        self.keys, self.order, self.hot = list(keys), order, hot
        self.rows, self.partition = rows, list(keys)
        if hot is not None:
            at = F.unix_micros(F.col(order).cast("timestamp"))
            slice_ = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= at)), F.lit(0))
            self.partition.append(_SLICE)
            self.rows = (
                rows.join(F.broadcast(hot), self.keys, "left")
                .withColumn(_SLICE, F.when(F.col("_cuts").isNull(), 0).otherwise(slice_))
                .drop("_cuts")
            )

    def _window(self, *ties: str) -> WindowSpec:
        return Window.partitionBy(*self.partition).orderBy(self.order, *ties)

    def _scan(
        self,
        rows: DataFrame,
        name: str,
        inside: Column,
        summary: Column,
        carried: Callable[[WindowSpec], Column],
        combine: Callable[[Column, Column], Column],
    ) -> DataFrame:
        """``inside`` within slices, combined with what ``carried`` brings over from other slices."""
        rows = rows.withColumn(name, inside)
        if self.hot is None:
            return rows
        # A semi join sinks below the windows, so only hot keys are gone through a second time.
        carry = (
            rows.join(F.broadcast(self.hot.select(*self.keys)), self.keys, "left_semi")
            .groupBy(*self.partition)
            .agg(summary.alias("_summary"))
            .select(*self.partition, carried(Window.partitionBy(*self.keys).orderBy(_SLICE)).alias("_carry"))
        )
        joined = rows.join(carry, self.partition, "left")
        return joined.withColumn(name, combine(F.col(name), F.col("_carry"))).drop("_carry")

    def previous(self, rows: DataFrame, value: Column, name: str) -> DataFrame:
        """``value``, which is never NULL, of the row before; NULL at the start."""
        return self._scan(
            rows,
            name,
            F.lag(value).over(self._window()),
            F.max_by(value, F.col(self.order)),
            lambda slices: F.lag("_summary").over(slices),
            F.coalesce,
        )

    def next(self, rows: DataFrame, name: str) -> DataFrame:
        """Time of the row after; NULL at the end."""
        return self._scan(
            rows,
            name,
            F.lead(self.order).over(self._window()),
            F.min(self.order),
            lambda slices: F.lead("_summary").over(slices),
            F.coalesce,
        )

    def max_before(self, rows: DataFrame, column: str, name: str, *ties: str) -> DataFrame:
        """Largest ``column`` over all earlier rows; ``ties`` orders rows of one time."""
        return self._scan(
            rows,
            name,
            F.max(column).over(self._window(*ties).rowsBetween(Window.unboundedPreceding, -1)),
            F.max(column),
            lambda slices: F.max("_summary").over(slices.rowsBetween(Window.unboundedPreceding, -1)),
            F.greatest,
        )

    def running_sum(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        """Sum of ``column`` up to and including the row; one row per key and time."""
        return self._scan(
            rows,
            name,
            F.sum(column).over(self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            F.sum(column),
            lambda slices: F.sum("_summary").over(slices.rowsBetween(Window.unboundedPreceding, -1)),
            lambda inside, carry: inside + F.coalesce(carry, F.lit(0)),
        )

    def number(self, rows: DataFrame, name: str) -> DataFrame:
        """Position of the row among those of its key, from 1; one row per key and time."""
        return self._scan(
            rows,
            name,
            F.row_number().over(self._window()),
            F.count("*"),
            lambda slices: F.sum("_summary").over(slices.rowsBetween(Window.unboundedPreceding, -1)),
            lambda inside, carry: inside + F.coalesce(carry, F.lit(0)),
        )

    def last_known(self, rows: DataFrame, value: Column, name: str) -> DataFrame:
        """The newest ``value`` that is not NULL, up to and including the row; NULL before the first.

        One row per key and time.
        """
        so_far = (Window.unboundedPreceding, Window.currentRow)
        return self._scan(
            rows,
            name,
            F.last(value, ignorenulls=True).over(self._window().rowsBetween(*so_far)),
            F.max_by(value, F.when(value.isNotNull(), F.col(self.order))),
            lambda slices: F.last("_summary", ignorenulls=True).over(slices.rowsBetween(Window.unboundedPreceding, -1)),
            F.coalesce,
        )
