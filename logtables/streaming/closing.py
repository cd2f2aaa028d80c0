"""A stream whose windows close once, and whose late rows are kept.

The clock of the stream is the latest arrival it has seen. A window closes when the clock is past its
end and the delay; its rows, written batch by batch until then, become visible by one finished run. A
row is late if it arrived after its window was to close, as in the batch export, or if it is delivered
after the window has been closed. Late rows go to a table of their own with the reason and the delay,
so on-time rows and late ones together are what was sent.

A watermark would drop late rows without a trace, so none is used. What the stream has to remember, the
clock and the counts of open windows, is part of the ledger record that a micro-batch ends with. A batch
that runs again starts from what the batch before it has left, and writes the same again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logtables.operators import windows
from logtables.plans.log_export import outcomes
from logtables.sinks import tables
from logtables.sinks.journal import Journal, run_of
from logtables.sources.runs import DONE, LATE, WRITTEN, read_runs
from logtables.spec import RUN_DELAY_MS, LogExportConfig
from logtables.streaming.export import EVERY_MINUTE

ARRIVED_LATE, WINDOW_CLOSED = "arrived_late", "window_closed"
LATE_FIELDS = T.StructType([
    T.StructField("window_start", T.LongType()), T.StructField("late_by_ms", T.LongType()),
    T.StructField("reason", T.StringType())])


def lateness(window_ms: int, delay_ms: int, clock_usec: int | None, arrival: str) -> Column:
    """Why a row with its `window_start` is late; null if it is not."""
    closes = (F.col("window_start") + window_ms + delay_ms) * 1000
    closed = F.lit(False) if clock_usec is None else closes < clock_usec
    return F.when(~F.coalesce(F.col(arrival) <= closes, F.lit(False)), ARRIVED_LATE).when(
        closed, WINDOW_CLOSED)


def write_batch(config: LogExportConfig, root: str, delay_ms: int = RUN_DELAY_MS,
                insert_id: str | None = "requestId", time: str = "start_time_usec",
                arrival: str = "arrival_usec", spread: int | None = None):
    """Export of one micro-batch: rows and rejects of open windows, late rows, windows to close."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, attempt = batch.sparkSession, f"batch-{batch_id}"
        journal = Journal(spark, f"{root}/runs", config.name)
        left = journal.state().stream or {"batch": -1, "clock": None, "open": {}, "before": None}
        if left["batch"] >= batch_id:
            left = left["before"]
        # The batch is read for the clock, for on-time rows and for late ones.
        batch = windows.assign_window(batch, config.window_ms, time).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            reason = lateness(config.window_ms, delay_ms, left["clock"], arrival)
            latest, late = batch.agg(F.max(arrival), F.count_if(reason.isNotNull())).first()
            found = outcomes(batch.where(reason.isNull()).drop("window_start", "window_end"), config,
                             insert_id, time)
            written = tables.write_attempt(
                found, config, root, attempt, insert_id,
                spread or tables.spread_of(spark, tasks=tables.tasks_of(found)))
            if late:
                by = F.floor((F.col(arrival) - (F.col("window_end") + delay_ms) * 1000) / 1000)
                (batch.where(reason.isNotNull())
                 .withColumns({"late_by_ms": by.cast("bigint"), "reason": reason})
                 .drop("window_end").write.mode("overwrite").parquet(late_path(root, config, attempt)))
        finally:
            batch.unpersist()
        clock = max([c for c in (left["clock"], latest) if c is not None], default=None)
        runs = [run_of(config.name, w, config.window_ms, **n) for w, n in sorted(written.items())]
        runs = [r | {"run_id": f"{r['run_id']}_{attempt}", "status": WRITTEN} for r in runs]
        if late:
            runs.append({"run_id": f"{config.name}_late_{attempt}", "window_start": 0,
                         "window_end": 0, "row_count": late, "status": LATE})
        open_ = {int(w): n for w, n in left["open"].items()}
        for w, n in written.items():
            rows, rejects = open_.get(w, (0, 0))
            open_[w] = (rows + n["row_count"], rejects + n["reject_count"])
        closed, open_ = closing(config, open_, clock, delay_ms)
        now = {"batch": batch_id, "clock": clock, "open": open_}
        journal.append(attempt, runs + closed, stream=now | {
            "before": {k: left[k] for k in now} | {"before": None}})

    return write


def closing(config: LogExportConfig, open_: dict[int, tuple[int, int]], clock_usec: int | None,
            delay_ms: int) -> tuple[list[dict], dict[int, tuple[int, int]]]:
    """Finished runs of the open windows that the clock has passed, and the windows still open."""
    done = [w for w in sorted(open_) if clock_usec is not None
            and (w + config.window_ms + delay_ms) * 1000 < clock_usec]
    runs = [run_of(config.name, w, config.window_ms, row_count=open_[w][0],
                   reject_count=open_[w][1], status=DONE, location=None) for w in done]
    return runs, {w: n for w, n in open_.items() if w not in set(done)}


def start_export(logs: DataFrame, config: LogExportConfig, root: str, checkpoint: str,
                 trigger: dict | None = None, **options) -> StreamingQuery:
    """Start the export; `options` go to `write_batch`. `tables.read_rows` and `read_rejects` show
    closed windows, `read_late` late rows. One query at a time writes a configuration."""
    return (logs.writeStream.foreachBatch(write_batch(config, root, **options))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_MINUTE)).start())


def close_windows(spark: SparkSession, config: LogExportConfig, root: str, now_ms: int,
                  delay_ms: int = RUN_DELAY_MS) -> list[int]:
    """Close what is due at a time although no later row has come, with the stream at rest; returns
    the windows. Rows of them that come later are late."""
    journal = Journal(spark, f"{root}/runs", config.name)
    left = journal.state().stream
    if left is None:
        return []
    clock = max(left["clock"] or now_ms * 1000, now_ms * 1000)
    closed, open_ = closing(config, {int(w): n for w, n in left["open"].items()}, clock, delay_ms)
    journal.append("clock", closed, stream=left | {"clock": clock, "open": open_})
    return [r["window_start"] for r in closed]


def late_path(root: str, config: LogExportConfig, attempt: str) -> str:
    return f"{root}/{config.name}/late/attempt={attempt}"


def read_late(spark: SparkSession, root: str, config: LogExportConfig, schema: T.StructType
              ) -> DataFrame:
    """Late rows, with the columns they came with (`schema`), their window, delay and reason."""
    full = T.StructType([*schema.fields, *LATE_FIELDS.fields])
    found = read_runs(spark, f"{root}/runs", config.name).where(F.col("status") == LATE)
    paths = sorted({late_path(root, config, r[0]) for r in found.select("location").collect()})
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(*paths)
