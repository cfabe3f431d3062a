"""History-keeping merge, literal policy: the end state of one run of the statement sequence
*insert unseen keys, find changed keys, close their versions, insert new versions, mark rows*.

The sequence only ever looks at active silver rows, so that is all the merge reads; closed
history is never scanned.  What a key needs is decided from per-key minima and maxima: some
pending value differs from some active value exactly when the two ranges are not one single
point.  That needs one aggregation with map-side combine, and no pairs are ever formed, however
many versions a key has.  Style D, which judges every row on its own, deals candidates and active
rows out by key once and compares them where they are, unless there are hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.dedupe import latest_by_load_time, pending
from stratum.operators.skew import HOT_ROWS, LOOK, any_null, find_hot, no_null, skew_join
from stratum.specs import MergeSpec

_ENDS = {"lo": F.min, "hi": F.max}


def any_of(tests: Sequence[Column]) -> Column:
    """OR in which an unknown comparison counts as no difference."""
    out = F.lit(False)
    for t in tests:
        out = out | F.coalesce(t, F.lit(False))
    return out


def to_silver_names(spec: MergeSpec, staging: DataFrame) -> DataFrame:
    """Pending-side projection: row id, business columns under silver names, lineage."""
    return staging.select(
        "row_id",
        *[F.col(spec.staging_column(c)).alias(c) for c in spec.business],
        "inserted_at",
        "origin_date",
    )


def version_rows(spec: MergeSpec, rows: DataFrame, valid_to: Column, active: Column) -> DataFrame:
    """Silver rows opened from pending rows; the load time starts the validity."""
    return rows.select(
        *spec.business,
        F.col("inserted_at").alias("valid_from"),
        valid_to.cast("timestamp_ntz").alias("valid_to"),
        active.alias("active"),
        F.col("inserted_at").alias("load_timestamp"),
        F.col("origin_date").alias("source_date"),
    )


def open_rows(spec: MergeSpec, rows: DataFrame) -> DataFrame:
    return version_rows(spec, rows, F.lit(None), F.lit(True))


def changed_pairs(spec: MergeSpec, active: DataFrame, rows: DataFrame, *, null_safe: bool) -> DataFrame:
    """Pending rows that differ from an active row of their key, by ``<>`` or null-safely.

    ``active`` must hold one row per key, as a clean silver table does.
    """
    current = active.select(*spec.keys, *[F.col(c).alias(f"_old_{c}") for c in spec.tracked])
    joined = skew_join(rows, current, spec.keys, "inner", find_hot(rows, spec.keys))
    if null_safe:
        differs = any_of([~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in spec.tracked])
    else:
        differs = any_of([F.col(c) != F.col(f"_old_{c}") for c in spec.tracked])
    return joined.where(differs).select(*rows.columns)


class LiteralMerge:
    """One literal merge run of ``staging`` into the active rows of a silver table.

    Every attribute is a lazy DataFrame.  ``broadcast_pending`` says that the caller has
    checked that the pending keys fit a broadcast: active rows are then filtered to those keys
    in place instead of taking part in the shuffle.  ``active_keys`` holds at least the keys of the
    active rows, each as often, where these are cheaper to look at; hot keys are then sought there.
    """

    def __init__(
        self,
        spec: MergeSpec,
        active: DataFrame,
        staging: DataFrame,
        *,
        broadcast_pending: bool = False,
        active_keys: DataFrame | None = None,
        hot_rows: int = HOT_ROWS,
        look: float = LOOK,
    ):
        if spec.style not in "ABCD":
            raise ValueError(f"{spec.entity} keeps no history")
        self.spec, self.staging = spec, staging
        self.keys = list(spec.keys)
        self.active = active
        self.active_keys = active if active_keys is None else active_keys
        self.broadcast_pending = broadcast_pending
        self.hot_rows, self.look = hot_rows, look

    # --- hot keys -------------------------------------------------------------------------

    @cached_property
    def hot_staging(self) -> DataFrame | None:
        """Hot keys among the staging rows, which bound those among the candidates."""
        return find_hot(self.staging, self.keys, self.hot_rows, self.look)

    @cached_property
    def hot_candidates(self) -> DataFrame | None:
        return None if self.spec.style == "B" else self.hot_staging

    @cached_property
    def hot_active(self) -> DataFrame | None:
        """Hot keys among the active rows: literal runs may leave many active rows per key."""
        return find_hot(self.active_keys, self.keys, self.hot_rows, self.look)

    @cached_property
    def _in_place(self) -> bool:
        """Style D without hot keys: see ``_side_by_side``."""
        plain = self.spec.style == "D" and not self.broadcast_pending
        return plain and self.hot_candidates is None and self.hot_active is None

    # --- candidates -----------------------------------------------------------------------

    @cached_property
    def newest_load(self) -> DataFrame:
        """Newest pending load time per complete key."""
        return (
            to_silver_names(self.spec, pending(self.staging))
            .where(no_null(self.keys))
            .groupBy(*self.keys)
            .agg(F.max("inserted_at").alias("_newest"))
        )

    @cached_property
    def candidates(self) -> DataFrame:
        """Staging rows the merge may insert: all pending, the newest, or all at the newest time."""
        spec = self.spec
        if spec.style == "B":
            return to_silver_names(spec, latest_by_load_time(self.staging, spec.keys))
        if spec.style == "C":
            rows = to_silver_names(spec, self.staging).where(no_null(self.keys))
            at_newest = skew_join(rows, self.newest_load, self.keys, "inner", self.hot_staging)
            return at_newest.where("inserted_at = _newest").drop("_newest")
        return to_silver_names(spec, pending(self.staging))

    @cached_property
    def keyless(self) -> DataFrame:
        """Candidates with a NULL in their key that are inserted nevertheless.

        ``NOT IN`` lets them through only while no row is active, ``NOT EXISTS`` always, and
        the equality join of style C never.
        """
        rows = self.candidates.where(any_null(self.keys))
        if self.spec.style == "A":
            count = self.active.agg(F.count("*")).scalar()
            return rows.where(count == 0)
        if self.spec.style == "C":
            return rows.limit(0)
        return rows

    # --- per-key facts --------------------------------------------------------------------

    @cached_property
    def key_stats(self) -> DataFrame:
        """Counts and value ranges per key over candidates and active rows, in one shuffle."""
        tracked = self.spec.tracked
        rows = self.candidates.where(no_null(self.keys)).select(
            F.lit(True).alias("_new_side"), *self.keys, *tracked, "inserted_at"
        )
        active = self.active.where(no_null(self.keys))
        if self.broadcast_pending:
            active = active.join(F.broadcast(rows.select(*self.keys).distinct()), self.keys, "left_semi")
        both = rows.unionByName(
            active.select(
                F.lit(False).alias("_new_side"),
                *self.keys,
                *tracked,
                F.lit(None).cast("timestamp_ntz").alias("inserted_at"),
            )
        )
        new_side = F.col("_new_side")
        aggregates = [
            F.max(new_side).alias("_pending"),
            F.max(~new_side).alias("_seen"),
            F.max("inserted_at").alias("_newest"),
            F.max(~new_side & no_null(tracked)).alias("_active_complete"),
        ]
        for c in tracked:
            for side, test in (("new", new_side), ("old", ~new_side)):
                value = F.when(test, F.col(c))
                aggregates += [F.min(value).alias(f"_{side}_lo_{c}"), F.max(value).alias(f"_{side}_hi_{c}")]
        return both.groupBy(*self.keys).agg(*aggregates)

    @cached_property
    def _side_by_side(self) -> DataFrame:
        """Style D without hot keys: candidates and active rows (``_new_side`` says which), each with the
        facts of its key.  Both are dealt out once, and nothing is joined.

        Keys with a NULL equal none: their candidates are unseen, and nothing of them is changed or ends.
        """
        tracked, new_side = self.spec.tracked, F.col("_new_side")
        candidates = self.candidates.withColumn("_new_side", F.lit(True))
        active = self.active.withColumn("_new_side", F.lit(False))
        by_key = Window.partitionBy(*self.keys)
        rows = candidates.unionByName(active, allowMissingColumns=True).withColumns(
            {
                "_unseen": ~F.max(~new_side).over(by_key),
                "_active_complete": F.max(~new_side & no_null(tracked)).over(by_key),
            }
        )
        # The rows of an unseen key are compared with each other, all others with the active ones.
        against = F.col("_unseen") | ~new_side
        ranges = {f"_{end}_{c}": of(F.when(against, F.col(c))).over(by_key) for c in tracked for end, of in _ENDS.items()}
        differs = any_of([F.col(c) != F.col(f"_{end}_{c}") for c in tracked for end in _ENDS])
        changed = new_side & no_null(self.keys) & differs
        ended = F.max(F.when(F.col("_changed"), F.col("inserted_at"))).over(by_key)
        judged = rows.withColumns(ranges).withColumn("_changed", changed).withColumn("_close", ended)
        return judged.drop(*ranges).withColumn("_unseen", F.col("_unseen") | any_null(self.keys))

    @cached_property
    def facts(self) -> DataFrame:
        """Keys with candidates: are they unseen, are they changed, which range to compare with.

        The rows of an unseen key are inserted before changes are looked for, so they are
        compared with each other.
        """
        tracked = self.spec.tracked
        unseen = ~F.col("_seen")
        if self.spec.style == "A":
            # NOT IN over a set that holds a NULL is never true.
            unseen = unseen & (self.active.agg(F.count_if(any_null(self.keys))).scalar() == 0)
        known = self.key_stats.where("_pending").withColumn("_unseen", unseen)
        against = {
            f"_{end}_{c}": F.when(F.col("_unseen"), F.col(f"_new_{end}_{c}")).otherwise(F.col(f"_old_{end}_{c}"))
            for c in tracked
            for end in ("lo", "hi")
        }
        changed = any_of(
            [F.col(f"_new_lo_{c}") != against[f"_hi_{c}"] for c in tracked]
            + [F.col(f"_new_hi_{c}") != against[f"_lo_{c}"] for c in tracked]
        )
        return known.select(
            *self.keys,
            "_unseen",
            "_newest",
            "_active_complete",
            *[column.alias(name) for name, column in against.items()],
            changed.alias("_changed"),
        )

    @cached_property
    def closings(self) -> DataFrame:
        """Changed keys and the time their active versions end."""
        if self.spec.style == "D":
            return self._compared.where("_changed").groupBy(*self.keys).agg(F.max("inserted_at").alias("_close"))
        return self.facts.where("_changed").select(*self.keys, F.col("_newest").alias("_close"))

    @cached_property
    def _compared(self) -> DataFrame:
        """Style D: candidates with their own change flag, taken from the key's ranges."""
        if self._in_place:
            return self.decided.drop("_close")
        tracked = self.spec.tracked
        ranges = [F.col(f"_{end}_{c}") for c in tracked for end in ("lo", "hi")]
        lookup = self.facts.select(*self.keys, "_unseen", "_active_complete", *ranges)
        rows = skew_join(
            self.candidates.where(no_null(self.keys)), lookup, self.keys, "inner", self.hot_candidates
        )
        differs = any_of([F.col(c) != F.col(f"_{end}_{c}") for c in tracked for end in ("lo", "hi")])
        return rows.withColumn("_changed", differs).select(
            *self.candidates.columns, "_unseen", "_active_complete", "_changed"
        )

    @cached_property
    def decided(self) -> DataFrame:
        """Candidates with a complete key and what happens to them: ``_unseen``, ``_changed``,
        and ``_close``, the end of the key's active versions if it has changed."""
        if self._in_place:
            return self._side_by_side.where(F.col("_new_side") & no_null(self.keys)).select(
                *self.candidates.columns, "_unseen", "_active_complete", "_changed", "_close"
            )
        if self.spec.style == "D" and self.hot_candidates is None:
            ended = F.max(F.when(F.col("_changed"), F.col("inserted_at"))).over(Window.partitionBy(*self.keys))
            return self._compared.withColumn("_close", ended)
        if self.spec.style == "D":
            return skew_join(self._compared, self.closings, self.keys, "left", self.hot_candidates)
        lookup = self.facts.select(
            *self.keys, "_unseen", "_changed", F.when(F.col("_changed"), F.col("_newest")).alias("_close")
        )
        return skew_join(
            self.candidates.where(no_null(self.keys)), lookup, self.keys, "inner", self.hot_candidates
        )

    # --- the steps ------------------------------------------------------------------------

    def new_rows(self) -> DataFrame:
        """Versions opened for keys without an active row."""
        return open_rows(
            self.spec, self.decided.where("_unseen").select(*self.candidates.columns).unionByName(self.keyless)
        )

    def changed(self) -> DataFrame:
        """Changed keys (A), with the closing time (B, C), or changed row ids (D)."""
        if self.spec.style == "D":
            return self._compared.where("_changed").select("row_id")
        if self.spec.style == "A":
            return self.closings.select(*self.keys)
        return self.closings.select(*self.keys, F.col("_close").alias("inserted_at"))

    def closed(self) -> DataFrame:
        """Versions this run ends, including those it opened itself for an unseen key."""
        opened = version_rows(
            self.spec, self.decided.where("_unseen AND _close IS NOT NULL"), F.col("_close"), F.lit(False)
        )
        return self._closed_active().unionByName(opened)

    def versions(self) -> DataFrame:
        """Versions opened for changed keys."""
        return open_rows(self.spec, self.decided.where("_changed"))

    def unchanged(self) -> DataFrame:
        """Style D: row ids equal to a row that is active once closing and inserting are done.

        A changed row equals the version it has just opened; in an unchanged key no value
        differs, so every complete row equals every complete active row.
        """
        return self.decided.where(self._unchanged_test).select("row_id")

    @property
    def _unchanged_test(self) -> Column:
        equal = F.col("_changed") | (F.col("_close").isNull() & (F.col("_unseen") | F.col("_active_complete")))
        return no_null(self.spec.tracked) & equal

    def _hits(self) -> DataFrame:
        """Staging with ``_hit`` on the rows the run counts as processed."""
        waiting = F.col("merge_status") == 0
        if self.spec.style == "D":
            done = (
                self.decided.where(F.col("_changed") | self._unchanged_test)
                .select("row_id")
                .unionByName(self.keyless.select("row_id"))
                .withColumn("_hit", F.lit(True))
            )
            return self.staging.join(done, "row_id", "left").withColumn("_hit", F.col("_hit") & waiting)
        if self.spec.style == "A":
            ended = skew_join(self.staging, self.closings, self.keys, "left", self.hot_staging)
            return ended.withColumn("_hit", F.col("_close").isNotNull() & waiting)
        hit = F.col("inserted_at") == F.col("_newest")
        dated = skew_join(self.staging, self.newest_load, self.keys, "left", self.hot_staging)
        return dated.withColumn("_hit", hit & waiting if self.spec.style == "B" else hit)

    def marked(self, *, pending_only: bool = False) -> DataFrame:
        """Staging with ``merge_status`` 1 on the processed rows; on request only what was pending."""
        rows = pending(self._hits()) if pending_only else self._hits()
        status = F.when(F.col("_hit"), 1).otherwise(F.col("merge_status"))
        return rows.withColumn("merge_status", status).select(*self.staging.columns)

    # --- the end state --------------------------------------------------------------------

    @cached_property
    def _active_with_end(self) -> DataFrame:
        if self._in_place:
            return self._side_by_side.where("NOT _new_side").select(*self.active.columns, "_close")
        if self.broadcast_pending:
            return self.active.join(F.broadcast(self.closings), self.keys, "left")
        return skew_join(self.active, self.closings, self.keys, "left", self.hot_active)

    def _closed_active(self) -> DataFrame:
        return self._ended(self._active_with_end.where("_close IS NOT NULL"))

    def _ended(self, rows: DataFrame) -> DataFrame:
        ends = F.col("_close").isNotNull()
        return (
            rows.withColumn("valid_to", F.when(ends, F.col("_close")).otherwise(F.col("valid_to")))
            .withColumn("active", F.when(ends, F.lit(False)).otherwise(F.col("active")))
            .select(*self.active.columns)
        )

    @staticmethod
    def _outcome(valid_to: Column, active: Column) -> Column:
        return F.struct(valid_to.cast("timestamp_ntz").alias("_to"), active.alias("_active"))

    def _insertions(self) -> Column:
        """What a candidate is inserted as: two rows where an unseen key is inserted, closed and inserted again."""
        return F.array_compact(
            F.array(
                F.when(F.col("_unseen"), self._outcome(F.col("_close"), F.col("_close").isNull())),
                F.when(F.col("_changed"), self._outcome(F.lit(None), F.lit(True))),
            )
        )

    def _opened(self) -> DataFrame:
        """All rows the run inserts, in one pass over the candidates."""
        rows = self.decided.where("_unseen OR _changed").select(*self.candidates.columns, F.inline(self._insertions()))
        return version_rows(self.spec, rows, F.col("_to"), F.col("_active")).unionByName(
            open_rows(self.spec, self.keyless)
        )

    def _delta_in_place(self) -> DataFrame:
        """``delta`` in one pass over candidates, with a complete key or not, and active rows."""
        ends, new_side = F.col("_close").isNotNull(), F.col("_new_side")
        stays = self._outcome(F.coalesce("_close", "valid_to"), F.when(ends, F.lit(False)).otherwise(F.col("active")))
        outcomes = F.when(new_side, self._insertions()).otherwise(F.array(stays))
        opened = {"valid_from": "inserted_at", "load_timestamp": "inserted_at", "source_date": "origin_date"}
        rows = self._side_by_side.select("*", F.inline(outcomes)).withColumns(
            {
                **{c: F.when(new_side, F.col(since)).otherwise(F.col(c)) for c, since in opened.items()},
                "valid_to": F.col("_to"),
                "active": F.col("_active"),
            }
        )
        return rows.select(*self.active.columns)

    def delta(self) -> DataFrame:
        """Active rows as the run leaves them, open or just closed, and everything it inserts."""
        if self._in_place:
            return self._delta_in_place()
        return self._ended(self._active_with_end).unionByName(self._opened())

    def result(self, history: DataFrame) -> DataFrame:
        """The whole silver table; ``history`` (inactive rows) passes through untouched."""
        return history.select(*self.active.columns).unionByName(self.delta())


def split_history(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Active rows and the rest; a NULL flag counts as not active."""
    return silver.where("active"), silver.where("NOT active OR active IS NULL")


def merge(spec: MergeSpec, silver: DataFrame, staging: DataFrame, **options) -> DataFrame:
    """Silver after one literal merge run."""
    active, history = split_history(silver)
    return LiteralMerge(spec, active, staging, active_keys=silver, **options).result(history)
