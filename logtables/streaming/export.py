"""Streaming export: bounded reads, replay removal within a watermark, idempotent micro-batches.

The batch export decides lateness by arrival time. A watermark works on event time instead, and only
where state is kept, that is in the replay removal: rows older than the watermark are dropped there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logtables.operators import combine
from logtables.plans.log_export import outcomes
from logtables.sinks import tables
from logtables.sinks.journal import Journal, run_of
from logtables.spec import LogExportConfig

EVERY_MINUTE = {"processingTime": "1 minute"}


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                name_pattern: str | None = None) -> DataFrame:
    """Parquet files as a stream. `max_files` bounds a micro-batch, also when catching up."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.parquet(path)


def drop_replays(logs: DataFrame, key: str = "request_id", time: str = "event_time",
                 delay: str = "60 seconds", merge_copies: bool = False) -> DataFrame:
    """One row per key within the watermark. State holds the ids of that span only.

    `merge_copies` is for streams in which one key is sent over and over: copies of a request agree
    in time as well, and those that meet in a task are merged there, at the price of passing all
    columns through Python. A stateful operator does not do this by itself.
    """
    if merge_copies:
        logs = logs.mapInArrow(combine.first_copies(key, time), logs.schema)
    return logs.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def write_batch(config: LogExportConfig, root: str, insert_id: str | None = "requestId",
                time: str = "start_time_usec", spread: int | None = None):
    """Export of one micro-batch on the row path of the batch export.

    A batch is an attempt named by its number: run again, it replaces its own files, and its ledger
    rows, one per window, have the same run ids. Bad values and over-size rows are set aside if the
    configuration says so.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        attempt = f"batch-{batch_id}"
        found = outcomes(batch, config, insert_id, time)
        counts = tables.write_attempt(found, config, root, attempt, insert_id,
                                      spread or tables.spread_of(batch.sparkSession,
                                                                 tasks=tables.tasks_of(found)))
        runs = [run_of(config.name, w, config.window_ms, **n) for w, n in sorted(counts.items())]
        Journal(batch.sparkSession, f"{root}/runs", config.name).append(
            attempt, [r | {"run_id": f"{r['run_id']}_{attempt}"} for r in runs])
    return write


def start_export(logs: DataFrame, config: LogExportConfig, root: str, checkpoint: str,
                 trigger: dict | None = None, **options) -> StreamingQuery:
    """Start the export; `options` go to `write_batch`. `tables.read_rows` and `read_rejects` show
    what whole batches have written."""
    return (logs.writeStream.foreachBatch(write_batch(config, root, **options))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_MINUTE)).start())


def start_append(rows: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    return (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_MINUTE)).start(path))
