"""Landing files as a stream: every file once, loaded and merged per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratum.plans.layers import Layers
from stratum.sources import landing


def start(
    spark: SparkSession,
    landing_folder: str,
    layers: Layers,
    checkpoint: str,
    loaded_at: Callable[[int], datetime],
    *,
    name: str = "landing",
    archive: str | None = None,
    max_files: int | None = None,
    on_rejects: Callable[[str, DataFrame], None] | None = None,
) -> StreamingQuery:
    """Process all files that have landed since the last call, then stop.

    The stream carries file paths only; the files are read by the batch plan of their entity, by
    header name.  The checkpoint remembers the files, and both commits of a batch carry the
    stream's ``name`` and the batch id, so a batch that is run again adds nothing twice.  With ``archive``,
    files move there once their load is committed; rejected ones stay where they are, and
    come again under another name.  ``loaded_at`` gives the load time of a batch.
    """
    options = {"ignoreMissingFiles": True}
    if max_files is not None:
        options["maxFilesPerTrigger"] = max_files
    files = landing.stream_files(spark, landing_folder, **options)

    def process(batch: DataFrame, batch_id: int) -> None:
        deliveries = landing.manifest(batch, per_file=True)
        label = f"{name} {batch_id}"
        folders = None if archive is None else (landing_folder, archive)
        for entity, rejects in layers.ingest(deliveries, loaded_at(batch_id), label, per_file=True, archive=folders):
            if on_rejects is not None:
                on_rejects(entity, rejects)
            if entity in layers.stores:
                layers.merge(entity, label)

    return (
        files.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
