"""Where jobs may write intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset in a local session, as in tests, a temporary folder is made and used instead; it
    is removed when the process ends.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="stratum-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set(_SETTING, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; else these stay until the driver collects its garbage."""
    before = spark.conf.get(_REMOVAL, None)
    spark.conf.set(_REMOVAL, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REMOVAL) if before is None else spark.conf.set(_REMOVAL, before)


def stored(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written as a table and read again; what was shuffled for it is removed."""
    with shuffles_removed(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
