"""History-keeping merge, clean policy.

The pending rows of a key are laid out in time after its active version, repeated states are
dropped, and every remaining row is valid until the next one begins.  One merge of several
loads gives the same table as one merge per load, and every pending row ends processed.

* changes are found null-safely, so an attribute may become NULL and come back
* rows not newer than the active version are late and change nothing
* of rows with one load time the highest row id counts
* rows with a NULL in their key are rejected
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.dedupe import latest_per_key, pending
from stratum.operators.ordered import KeyedSequence
from stratum.operators.scd2 import split_history, to_silver_names
from stratum.operators.skew import HOT_ROWS, LOOK, any_null, find_hot, find_hot_ranges, no_null, skew_join
from stratum.specs import MergeSpec

# Row id of the version that is active already; staging ids start above it.
_ACTIVE_ID = -1


class CleanMerge:
    """One clean merge of ``staging`` into the active rows of a silver table, lazily."""

    def __init__(
        self,
        spec: MergeSpec,
        active: DataFrame,
        staging: DataFrame,
        *,
        hot_rows: int = HOT_ROWS,
        look: float = LOOK,
    ):
        self.spec, self.active = spec, active
        self.hot_rows, self.look = hot_rows, look
        self.keys, self.tracked = list(spec.keys), list(spec.tracked)
        self._pending = pending(staging)

    def rejected(self) -> DataFrame:
        return self._pending.where(any_null(self.keys))

    @cached_property
    def _dated(self) -> DataFrame:
        """Pending rows next to the start of their key's active version."""
        rows = to_silver_names(self.spec, self._pending).where(no_null(self.keys))
        since = self.active.groupBy(*self.keys).agg(F.max("valid_from").alias("_since"))
        hot = find_hot(self._pending, self.keys, self.hot_rows, self.look)
        return skew_join(rows, since, self.keys, "left", hot)

    def late(self) -> DataFrame:
        """Pending rows that are not newer than the active version of their key."""
        return self._dated.where("inserted_at <= _since").drop("_since")

    def refused(self) -> DataFrame:
        """Pending rows without a version of their own because their key is NULL or they are late, with the reason."""
        names = self._pending.columns
        waiting = self._pending.where(no_null(self.keys))
        since = self.active.groupBy(*self.keys).agg(F.max("valid_from").alias("_since"))
        late = skew_join(waiting, since, self.keys, "inner", find_hot(waiting, self.keys, self.hot_rows, self.look))
        return (
            late.where("inserted_at <= _since").select(*names, F.lit("late").alias("reason"))
            .unionByName(self.rejected().select(*names, F.lit("null key").alias("reason")))
        )

    @cached_property
    def _hot_times(self) -> DataFrame | None:
        times = self._pending.select(*self.keys, F.col("inserted_at").alias("valid_from"))
        return find_hot_ranges(times, self.keys, "valid_from", self.hot_rows, self.look)

    def _states(self) -> DataFrame:
        """Active rows and the pending ones that are newer, one of each time.

        Without hot keys both are dealt out and sorted by key once: nothing is joined, and the windows that follow
        find their rows where they are.
        """
        last_of_time = [F.col("row_id").desc()]
        if self._hot_times is None:
            load = self.active.schema["load_timestamp"].dataType
            pending_rows = to_silver_names(self.spec, self._pending).where(no_null(self.keys)).select(
                *self.keys, *self.tracked, F.col("inserted_at").alias("valid_from"), F.lit(None).cast(load).alias("load_timestamp"),
                F.col("origin_date").alias("source_date"), "row_id", F.lit(False).alias("_current"),
            )
            both = self._current.withColumn("_current", F.lit(True)).unionByName(pending_rows)
            whole = (Window.unboundedPreceding, Window.unboundedFollowing)
            of_key = Window.partitionBy(*self.keys).orderBy("valid_from", *last_of_time).rowsBetween(*whole)
            since = F.max(F.when(F.col("_current"), F.col("valid_from"))).over(of_key)
            newer = both.withColumn("_since", since).where("_current OR _since IS NULL OR valid_from > _since")
            loaded = F.when(F.col("_current"), F.col("load_timestamp")).otherwise(F.col("valid_from"))
            rows = newer.withColumn("load_timestamp", loaded).drop("_since", "_current")
            return latest_per_key(rows, [*self.keys, "valid_from"], last_of_time)
        fresh = self._dated.where("_since IS NULL OR inserted_at > _since").select(
            *self.keys,
            *self.tracked,
            F.col("inserted_at").alias("valid_from"),
            F.col("inserted_at").alias("load_timestamp"),
            F.col("origin_date").alias("source_date"),
            "row_id",
        )
        return latest_per_key(self._current.unionByName(fresh), [*self.keys, "valid_from"], last_of_time)

    @property
    def _current(self) -> DataFrame:
        return self.active.select(
            *self.keys, *self.tracked, "valid_from", "load_timestamp", "source_date",
            F.lit(_ACTIVE_ID).cast("long").alias("row_id"),
        )

    @cached_property
    def delta(self) -> DataFrame:
        """Everything that replaces the active rows: kept, closed and new versions."""
        timeline = KeyedSequence(self._states(), self.keys, "valid_from", self._hot_times)
        state = F.struct(*self.tracked)
        states = timeline.previous(timeline.rows, state, "_previous")
        steps = states.where(F.col("_previous").isNull() | ~F.col("_previous").eqNullSafe(state))
        return timeline.next(steps, "valid_to").select(
            *self.keys,
            *self.tracked,
            "valid_from",
            "valid_to",
            F.col("valid_to").isNull().alias("active"),
            "load_timestamp",
            "source_date",
        )

    def result(self, history: DataFrame) -> DataFrame:
        return history.select(*self.delta.columns).unionByName(self.delta)


def merge(spec: MergeSpec, silver: DataFrame, staging: DataFrame, **options) -> DataFrame:
    """Silver after one clean merge run."""
    active, history = split_history(silver)
    return CleanMerge(spec, active, staging, **options).result(history)


def mark_all_processed(staging: DataFrame) -> DataFrame:
    """New, changed, unchanged, late and rejected rows have all been dealt with."""
    return staging.withColumn("merge_status", F.lit(1))
