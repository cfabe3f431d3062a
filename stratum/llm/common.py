"""What the operators of this package share: stored tables, words, prefix sums, joins of hot keys."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"

#: White space between words: the six ASCII characters, and only these.
SPACES = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one that ``spark.checkpoint.dir`` names.

    Only a local session without that setting, as in tests, gets a temporary folder, which is
    removed when the process ends; on a cluster the setting is required.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="stratum-llm-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set(_SETTING, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written as a table in the shared folder and read again: cuts the lineage, fixes every value."""
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    _folders[table] = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Remove the files of ``stored`` tables that nothing will read any more."""
    for table in tables:
        path = _folders.pop(table, None) if table is not None else None
        if path is not None:
            at = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


_sent: set[str] = set()


def _send_package(spark: SparkSession) -> None:
    """Give executors this package unless their path has it already."""
    package = Path(__file__).resolve().parents[1]
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if context.applicationId in _sent or any(os.path.realpath(p or ".") == str(package.parent) for p in paths):
        return
    folder = tempfile.mkdtemp(prefix="stratum-package-")  # the driver serves it as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(archive)
    _sent.add(context.applicationId)


def arrow_batches(rows: DataFrame, most: int = 256) -> DataFrame:
    """Keep the batches that Python gets small enough for long texts, and send this package along; returns ``rows``."""
    _send_package(rows.sparkSession)
    conf = rows.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != most:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(most))
    return rows


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def shingle_hashes(tokens: Column, width: int) -> Column:
    """64-bit hashes of all runs of ``width`` words; a shorter text is one run, a text without words none."""
    # ``tokens`` should be a column of the rows: as an expression it would be evaluated for every run.
    n = F.size(tokens)
    runs = F.transform(
        F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(width)])
    )
    none = F.array().cast("array<bigint>")
    return F.when(n == 0, none).when(n < width, F.array(F.xxhash64(tokens))).otherwise(runs)


def running_totals(
    rows: DataFrame, order: Sequence[str], values: dict[str, str], group: str | None = None, purpose: str = "ranged"
) -> DataFrame:
    """Add, for each ``name: column``, the sum of the column over all rows before this one.

    Rows are dealt out by ranges of ``order`` (within ``group``, a column without nulls) and kept with
    the number of their range.  Sums run inside ranges; a table of one row per range and group carries
    the totals of earlier ranges over.  No task sees more than one range, however large a group is.
    """
    keys = [group] if group else []
    ranged = stored(
        rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), purpose
    )
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range", *keys).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in values.items()])
    carried = totals.select(
        "_range", *keys, *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_from_{n}") for n in values]
    )
    summed = ranged.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in values.items()})
    joined = summed.join(carried, ["_range", *keys])
    return joined.withColumns({n: F.col(n) + F.col(f"_from_{n}") for n in values}).drop(
        "_range", *[f"_from_{n}" for n in values]
    )


def salted_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, salts: int = 16) -> DataFrame:
    """Join with a narrow ``lookup`` of one row per key; a key's ``rows`` spread over ``salts`` tasks."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int")
    repeated = lookup.withColumn("_spread", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_spread", salt).join(repeated, [*keys, "_spread"], how).drop("_spread")
