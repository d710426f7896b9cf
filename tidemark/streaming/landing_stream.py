"""Structured Streaming delivery of the incremental load.

The landing folder is a file stream source: each new payload file is picked up once, the
stream's checkpoint remembers which, and every micro-batch runs the batch load of
``tidemark.plans.load`` (classify -> quarantine -> parse -> high-water mark -> dedupe ->
append), which reads the batch's files once. ``foreachBatch`` is at-least-once; a load carries
the id of its query and epoch, by which the table's ledger knows a replayed batch, finishes
an interrupted one, and keeps one row of metrics for each.

The checkpoint location must be on shared storage on a cluster (it is what lets a restarted
query, or a query that lost executors, resume without reprocessing or skipping files).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.load import FAMILIES, load_batch
from tidemark.sources.landing import landed_rows


def landed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of ``read_landed``: one row per new landed file."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return landed_rows(reader.load(path))


def _batch_loader(family: str, checkpoint: str, mode: str, on_load: Callable[[dict], None] | None):
    def load(batch: DataFrame, epoch_id: int) -> None:
        # The batch carries its own (cloned) session; use it, not the caller's.
        spark = batch.sparkSession
        # The query's own id is new for a new checkpoint, whose epochs start at 0 again.
        query = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").agg(F.max("value")).first()[0]
        metrics = load_batch(batch, family, mode, load_id=f"{json.loads(query)['id']}/{epoch_id}")
        spark.catalog.refreshTable(FAMILIES[family].table)
        if on_load is not None:
            on_load(metrics)

    return load


def start_landing_stream(
    spark: SparkSession,
    path: str,
    family: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    on_load: Callable[[dict], None] | None = None,
    mode: str = "increment",
) -> StreamingQuery:
    """Start the stream for one payload family. With ``available_now`` it processes every
    file present and stops (a scheduled daily run); otherwise it runs on ``processing_time``.
    ``on_load`` gets the metrics of every batch; ``mode="backfill"`` loads re-fetched days."""
    writer = (
        landed_stream(spark, path, max_files_per_trigger)
        .writeStream.foreachBatch(_batch_loader(family, checkpoint_location, mode, on_load))
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
