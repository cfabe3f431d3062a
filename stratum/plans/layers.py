"""The whole way from landing files to gold on stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import dedupe, gold, quality, scd1, scd2, scd2_clean
from stratum.operators.skew import any_null
from stratum.schemas import empty
from stratum.sources import landing
from stratum.sources.gold_table import GoldTable
from stratum.sources.tables import BUCKETS, REFUSED, SILVER, STAGING, EntityStore
from stratum.specs import SPECS

LITERAL, CLEAN = "literal", "clean"

# Pending rows up to this many are broadcast by key; more take part in the shuffle.
_BROADCAST_PENDING = 1_000_000


class Layers:
    """Staging, silver and gold of all entities below one folder.

    ``policy`` chooses the history merge: ``clean`` or ``literal``.  ``buckets`` is the number of parts of a new
    upserted table.
    """

    def __init__(self, spark: SparkSession, folder: str, policy: str = CLEAN, *, buckets: int = BUCKETS):
        if policy not in (LITERAL, CLEAN):
            raise ValueError(policy)
        self.spark, self.folder, self.policy = spark, folder, policy
        self.stores = {e: EntityStore(spark, folder, e, buckets) for e in SPECS}

    def staging(self, entity: str) -> DataFrame:
        return self.stores[entity].read(STAGING)

    def silver(self, entity: str) -> DataFrame:
        return self.stores[entity].read(SILVER)

    # --- bronze ---------------------------------------------------------------------------

    def ingest(
        self,
        deliveries: DataFrame,
        loaded_at: datetime,
        label: str,
        *,
        per_file: bool = False,
        archive: tuple[str, str] | None = None,
    ) -> list[tuple[str, DataFrame]]:
        """Add every loadable delivery to its staging table; returns, per entity, deliveries not loaded and why.

        A delivery is loaded once, whatever the label: its path is kept with the commit, so a repeated call adds
        nothing, and reports it.  Rejected deliveries are not remembered and may come again.  A table that
        several deliveries feed is loaded by one plan; its files are parsed once.

        With ``archive``, the landing folder and another one, what has been loaded moves there once it is committed.
        The commit is the journal of these moves: a delivery that a failed run left in landing is known
        to be loaded, so the next call moves it and loads nothing twice.  Rejected deliveries stay.
        """
        # The list is made once: files move, and more may land, while it is worked through.
        listed = f"{self.folder.rstrip('/')}/listed/{uuid.uuid4().hex[:12]}"
        deliveries.write.parquet(listed)
        deliveries = self.spark.read.schema(deliveries.schema).parquet(listed)
        named = [r.table_name for r in deliveries.select("table_name").distinct().collect()]
        rejects = []
        for entity in sorted(set(named) & set(SPECS)):
            store = self.stores[entity]
            own, known = deliveries.where(F.col("table_name") == entity), store.deliveries()
            skipped = own.join(known, "delivery", "left_semi").select("delivery", F.lit("already loaded").alias("reason"))
            parsed = f"{store.folder}/parsed/{uuid.uuid4().hex[:12]}"
            load = landing.load(
                self.spark, own.join(known, "delivery", "left_anti"), entity, loaded_at,
                first_id=store.last_row_id() + 1, parsed=f"{parsed}/typed", numbered=f"{parsed}/numbered", per_file=per_file,
            )
            refused = self.spark.createDataFrame(
                load.rejects.unionByName(skipped).collect(), "delivery string, reason string"  # at most one per delivery
            )
            accepted = sorted({d.path for d in load.found} - {r.delivery for r in refused.collect()})
            if accepted:
                store.commit(f"load {label}", added=True, deliveries=accepted, staging=load.rows)
            store.remove(parsed)
            if archive is not None:
                landing.move(self.spark, [*accepted, *[r.delivery for r in skipped.collect()]], *archive)
            rejects.append((entity, refused))
        unknown = deliveries.where(F.col("table_name").isNull() | ~F.col("table_name").isin(*SPECS)).select("delivery", "reason")
        rejects.append(("unknown", self.spark.createDataFrame(unknown.collect(), unknown.schema)))
        next(iter(self.stores.values())).remove(listed)
        return rejects

    # --- silver ---------------------------------------------------------------------------

    def merge(self, entity: str, label: str) -> DataFrame:
        """Merge the pending rows of one entity; staging and silver change together.

        A label that has been merged since the last load is not merged again.  Returns the pending rows that the
        clean policy takes no version from, with the reason; they are stored too (``refused``).
        """
        store, spec = self.stores[entity], SPECS[entity]
        nothing = empty(self.spark, store.schemas[REFUSED])
        if store.has(f"merge {label}"):
            return nothing
        pending, tables, replaced = store.current(STAGING), {}, []
        if spec.style == "E":
            # Only the buckets that pending keys fall into are read and written again.
            replaced = store.buckets_of(dedupe.pending(pending))
            if replaced:
                tables[SILVER] = scd1.upsert(store.in_buckets(replaced), pending)
            tables[STAGING] = scd1.mark_processed(pending) if self.policy == LITERAL else scd2_clean.mark_all_processed(pending)
            if self.policy == CLEAN:
                lost = pending.where(any_null(list(spec.keys)) & (F.col("merge_status") == 0))
                tables[REFUSED] = lost.withColumn("reason", F.lit("null key"))
        elif self.policy == CLEAN:
            merge = scd2_clean.CleanMerge(spec, store.current(SILVER), pending)
            tables = {SILVER: merge.delta, STAGING: scd2_clean.mark_all_processed(pending), REFUSED: merge.refused()}
        else:
            rows = pending.unionByName(self._of_pending_loads(store)) if spec.style == "C" else pending
            few = pending.count() <= _BROADCAST_PENDING
            run = scd2.LiteralMerge(spec, store.current(SILVER), rows, broadcast_pending=few)
            tables = {SILVER: run.delta(), STAGING: run.marked(pending_only=True)}
        before = {r.attempt for r in store.commits().select(F.explode("settled_refused").alias("attempt")).collect()}
        store.commit(f"merge {label}", replaced=replaced, **tables)
        after = {r.attempt for r in store.commits().select(F.explode("settled_refused").alias("attempt")).collect()}
        return store._read(REFUSED, [f"{a}/kind=settled" for a in sorted(after - before)])

    @staticmethod
    def _of_pending_loads(store: EntityStore) -> DataFrame:
        """Processed staging rows of the loads that pending rows are from, which style C looks at too.

        A load has one time, and files hold few loads each, so the scan skips the files of all other loads.
        """
        loads = dedupe.pending(store.current(STAGING)).select("inserted_at").distinct().collect()  # one per load
        times = [F.lit(r.inserted_at.isoformat(sep=" ")).cast("timestamp_ntz") for r in loads if r.inserted_at]
        return store.settled(STAGING).where(F.col("inserted_at").isin(*times) if times else F.lit(False))

    def snapshot(self, entity: str, at: datetime) -> DataFrame:
        """The versions of one entity that hold at a time."""
        return self.stores[entity].snapshot(at)

    def refused(self, entity: str) -> DataFrame:
        """All pending rows that clean merges took no version from."""
        return self.stores[entity].read(REFUSED)

    def merge_all(self, label: str, entities: Iterable[str] = tuple(SPECS)) -> None:
        for entity in entities:
            self.merge(entity, label)

    # --- gold and checks ------------------------------------------------------------------

    def gold(self) -> DataFrame:
        return gold.sales_analytics(
            *[self.silver(e) for e in ("salestransactions", "customers", "flavours", "recipes", "ingredients")]
        )

    def create_gold_view(self) -> DataFrame:
        view = self.gold()
        gold.create_view(view)
        return view

    def check(self, entity: str) -> DataFrame:
        """Report of both layers of one entity."""
        return quality.together([
            quality.staging_checks(self.staging(entity), entity),
            quality.silver_checks(self.silver(entity), entity),
        ])

    def unprocessed(self, entity: str) -> DataFrame:
        """Rows that a merge has left pending."""
        return quality.unprocessed(self.stores[entity].current(STAGING), entity)

    def check_gold(self) -> DataFrame:
        return quality.gold_checks(self.gold())

    def write_gold(self, path: str) -> None:
        """The gold view as a table partitioned by month of sale, in order of date and id inside each file."""
        gold.write_by_month(self.gold(), path)

    def refresh_gold(self, path: str) -> list[str]:
        """Keep the gold view as a table: only months that changes since the last call touch are written again.

        Sales that may have changed are those in buckets an upsert has written since.  Returns the months written.
        """
        table, store = GoldTable(self.spark, path), self.stores["salestransactions"]
        parts, known = store.parts(), set(table.sources())
        changed = store.in_buckets({b for part, b in parts.items() if part not in known}).select("transaction_id")
        return table.refresh(
            *[self.silver(e) for e in ("salestransactions", "customers", "flavours", "recipes", "ingredients")],
            changed_sales=changed, sources=parts,
        )
