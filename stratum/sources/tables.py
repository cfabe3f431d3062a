"""Staging and silver tables of one entity on plain parquet.

    <folder>/<table>/<attempt>/kind=current    rows that were open when the attempt was written
    <folder>/<table>/<attempt>/kind=settled    rows it settled: processed staging, closed versions
    <folder>/silver/<attempt>/kind=current/bucket=<n>    the same for an upserted table, by a hash of the key
    <folder>/commits                           one row per committed run

Every attempt to write has a folder of its own, and a commit row names the attempts that count: those
with the open rows of each table from now on, and those with rows this run settled.  What a failed
run leaves behind is named nowhere and never read; ``vacuum`` removes it.  A load adds its rows as a further
attempt, a merge replaces the open ones, an upsert those of the buckets its keys fall into: the others stay
where they are, in the attempts that wrote them.  Both tables of a run become visible together.  The commit row
of a history-keeping table has the times its newly closed versions cover, so that a snapshot leaves out runs that
closed nothing of its time.  One writer per entity.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.history import snapshot
from stratum.operators.skew import no_null
from stratum.schemas import empty, silver_schema, staging_schema
from stratum.session import bound_tasks
from stratum.specs import SPECS

STAGING, SILVER, REFUSED = "staging", "silver", "refused"

_NAMES = T.ArrayType(T.StringType())
_COMMIT = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("label", T.StringType()),
        *[T.StructField(t, _NAMES) for t in (STAGING, SILVER, REFUSED)],
        *[T.StructField(f"settled_{t}", _NAMES) for t in (STAGING, SILVER, REFUSED)],
        T.StructField("deliveries", _NAMES),
        T.StructField("last_row_id", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("closed_from", T.TimestampNTZType()),
        T.StructField("closed_to", T.TimestampNTZType()),
    ]
)

#: Parts of a new upserted table; a table keeps the number it was made with.
BUCKETS = 256


class EntityStore:
    def __init__(self, spark: SparkSession, folder: str, entity: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.spec = bound_tasks(spark), f"{folder.rstrip('/')}/{entity}", SPECS[entity]
        self._new_buckets = buckets if self.spec.style == "E" else None
        staging = staging_schema(entity)
        refused = T.StructType([*staging.fields, T.StructField("reason", T.StringType())])
        self.schemas = {STAGING: staging, SILVER: silver_schema(entity), REFUSED: refused}

    # --- commits --------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMIT).parquet(f"{self.folder}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, _COMMIT)

    def _last(self) -> T.Row:
        newest = self.commits().orderBy(F.col("run").desc()).limit(1).collect()
        return newest[0] if newest else T.Row(run=0, staging=[], silver=[], refused=[], last_row_id=0, buckets=None)

    def has(self, label: str) -> bool:
        """Whether a run of this label has been committed and nothing has been loaded since."""
        newest = self.commits().agg(
            F.max(F.when(F.col("label") == label, F.col("run"))),
            F.coalesce(F.max(F.when(F.size("deliveries") > 0, F.col("run"))), F.lit(0)),
        ).first()
        return newest[0] is not None and newest[0] > newest[1]

    def deliveries(self) -> DataFrame:
        """Paths of all deliveries that have been loaded."""
        return self.commits().select(F.explode("deliveries").alias("delivery"))

    def last_row_id(self) -> int:
        return self._last().last_row_id or 0

    # --- rows -----------------------------------------------------------------------------

    def _read(self, table: str, folders: Iterable[str]) -> DataFrame:
        schema, paths = self.schemas[table], [f"{self.folder}/{table}/{f}" for f in folders]
        if not paths:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _open(self, table: str) -> list[str]:
        return ["/kind=current/".join(a.split("/", 1)) if "/" in a else f"{a}/kind=current" for a in self._last()[table]]

    def _closed(self, table: str) -> list[str]:
        named = self.commits().select(F.explode(f"settled_{table}").alias("attempt")).collect()  # one per run
        return [f"{r.attempt}/kind=settled" for r in named]

    def current(self, table: str) -> DataFrame:
        return self._read(table, self._open(table))

    def settled(self, table: str) -> DataFrame:
        return self._read(table, self._closed(table))

    def read(self, table: str) -> DataFrame:
        return self._read(table, [*self._open(table), *self._closed(table)])

    # --- buckets --------------------------------------------------------------------------

    def parts(self) -> dict[str, int]:
        """The bucket of each attempt's part that the upserted table consists of; a rewritten bucket has a new part."""
        return {name: int(name.rpartition("=")[2]) for name in self._last()[SILVER] if "/bucket=" in name}

    @property
    def buckets(self) -> int | None:
        """Parts of the silver table by key, None if it is not divided."""
        return self._last().buckets or self._new_buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of ``rows`` fall into."""
        found = rows.where(no_null(list(self.spec.keys))).select(self._bucket().alias("bucket")).distinct().collect()
        return sorted(r.bucket for r in found)  # at most one per bucket

    def in_buckets(self, buckets: Iterable[int]) -> DataFrame:
        """The silver rows of some buckets; no others are listed or read."""
        wanted = {f"bucket={b}" for b in buckets}
        return self._read(SILVER, [f for f in self._open(SILVER) if f.rpartition("/")[2] in wanted])

    def snapshot(self, at: datetime) -> DataFrame:
        """Versions that hold at a time, from the open ones and the runs whose closed versions cover it."""
        time = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
        covering = self.commits().where((F.col("closed_from") <= time) & (F.col("closed_to") > time))
        named = covering.select(F.explode("settled_silver").alias("attempt")).collect()  # one per run that covers the time
        return snapshot(self._read(SILVER, [*self._open(SILVER), *[f"{r.attempt}/kind=settled" for r in named]]), at)

    def _write(self, table: str, rows: DataFrame, path: str) -> None:
        kind = _settled(rows, table).alias("kind")
        parts, columns = ["kind"], [*self.schemas[table].fieldNames(), kind]
        if table == SILVER and self.buckets:
            parts.append("bucket")
            rows = rows.select(*columns, self._bucket().alias("bucket")).hint("rebalance", "bucket")
        else:
            rows = rows.select(*columns)
        rows.write.partitionBy(*parts).parquet(path)

    def commit(
        self, label: str, *, added: bool = False, deliveries: Iterable[str] = (), replaced: Iterable[int] = (), **tables: DataFrame
    ) -> int:
        """Store open and newly settled rows of ``staging``, ``silver`` and/or ``refused``.

        With ``added`` they come to the open rows there are, else they replace them; in a table with buckets they
        replace those of the buckets ``replaced``, and must all fall into these.
        """
        last, times = self._last(), T.Row(first=None, last=None)
        row = {t: list(last[t]) for t in self.schemas} | {f"settled_{t}": [] for t in self.schemas}
        newest_id = last.last_row_id or 0
        for table, rows in tables.items():
            attempt = f"run={last.run + 1}-{uuid.uuid4().hex[:12]}"
            path = f"{self.folder}/{table}/{attempt}"
            self._write(table, rows, path)
            if self._exists(f"{path}/kind=settled"):
                row[f"settled_{table}"] = [attempt]
                if table == SILVER:
                    closed = self._read(table, [f"{attempt}/kind=settled"])
                    times = closed.agg(F.min("valid_from").alias("first"), F.max("valid_to").alias("last")).first()
            if table == SILVER and self.buckets:
                gone = {f"bucket={b}" for b in replaced}
                kept = [n for n in row[table] if n.rpartition("/")[2] not in gone]
                row[table] = kept + [f"{attempt}/{b}" for b in sorted(gone) if self._exists(f"{path}/kind=current/{b}")]
                continue
            written = [attempt] if self._exists(f"{path}/kind=current") else []
            row[table] = row[table] + written if added else written
            if added and table == STAGING and written:
                newest_id = max(newest_id, self._read(table, [f"{attempt}/kind=current"]).agg(F.max("row_id")).first()[0])
        values = {"run": last.run + 1, "label": label, "deliveries": list(deliveries), "last_row_id": newest_id} | row
        values |= {"buckets": self.buckets, "closed_from": times.first, "closed_to": times.last}
        commit = self.spark.createDataFrame([tuple(values[f.name] for f in _COMMIT)], _COMMIT)
        commit.coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return last.run + 1

    # --- files ----------------------------------------------------------------------------

    def _path(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path, jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        at, files = self._path(path)
        return files.exists(at)

    def remove(self, path: str) -> None:
        at, files = self._path(path)
        files.delete(at, True)

    def vacuum(self) -> list[str]:
        """Remove what no later read needs: attempts without a commit, open rows that have been replaced, and parsed
        files that a failed load left.

        Not while another process reads or writes the entity.  Returns the removed folders.
        """
        gone = []
        for table in self.schemas:
            kept = {*self._open(table), *self._closed(table)}
            for name in self._children(table):
                if not any(k.startswith(f"{name}/") for k in kept):
                    gone.append(f"{table}/{name}")
                    continue
                for kind in self._children(f"{table}/{name}"):
                    own = f"{name}/{kind}"
                    if own not in kept and not any(k.startswith(f"{own}/") for k in kept):
                        gone.append(f"{table}/{own}")
                    elif own not in kept:
                        gone += [f"{table}/{own}/{b}" for b in self._children(f"{table}/{own}") if f"{own}/{b}" not in kept]
        gone += [f"parsed/{name}" for name in self._children("parsed")]
        for path in gone:
            self.remove(f"{self.folder}/{path}")
        return gone

    def _children(self, path: str) -> list[str]:
        top, files = self._path(f"{self.folder}/{path}")
        found = files.listStatus(top) if files.exists(top) else []
        return sorted(n for n in (f.getPath().getName() for f in found) if n[0] not in "._")


def _settled(rows: DataFrame, table: str):
    if table == REFUSED:
        settled = F.lit(True)
    elif "active" in rows.columns:
        settled = ~F.coalesce(F.col("active"), F.lit(False))
    elif "merge_status" in rows.columns:
        settled = F.col("merge_status") != 0
    else:
        settled = F.lit(False)
    return F.when(settled, "settled").otherwise("current")
