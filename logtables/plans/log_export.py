"""The log export: windows, selection, rows, tables, ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.operators import filters, rows, windows
from logtables.session import delete_dir
from logtables.sinks import tables
from logtables.sinks.journal import CLAIM_MS, Journal, run_of
from logtables.sources import logs as log_source
from logtables.spec import LogExportConfig


def select_logs(logs: DataFrame, config: LogExportConfig) -> DataFrame:
    """Level, versions and skip predicate. Spark evaluates them ahead of the extraction."""
    kept = filters.min_level(logs, config.min_level)
    kept = filters.versions(kept, config.versions())
    return filters.skip(kept, config.field_set.skip)


def window_rows(logs: DataFrame, config: LogExportConfig, time: str = "start_time_usec"
                ) -> DataFrame:
    """Typed rows of the selected logs with their window, from one projection."""
    kept = windows.assign_window(select_logs(logs, config), config.window_ms, time)
    return rows.export_rows(kept, config.field_set, keep=["window_start"])


def checked_window_rows(logs: DataFrame, config: LogExportConfig, time: str = "start_time_usec"
                        ) -> DataFrame:
    kept = windows.assign_window(select_logs(logs, config), config.window_ms, time)
    return rows.checked_rows(kept, config.field_set, config.max_row_bytes, keep=["window_start"])


def outcomes(logs: DataFrame, config: LogExportConfig, insert_id: str | None = "requestId",
             time: str = "start_time_usec") -> DataFrame:
    """Good rows and, where the configuration sets rows aside, rejects: one pass over the logs."""
    if config.max_row_bytes is None:
        return window_rows(logs, config, time).withColumn("outcome", F.lit(rows.ROWS))
    return rows.outcome_rows(checked_window_rows(logs, config, time), config.field_set,
                             insert_id or "requestId", keep=["window_start"])


def export_windows(logs: DataFrame, config: LogExportConfig, wanted: DataFrame, root: str,
                   time: str = "start_time_usec", insert_id: str | None = "requestId",
                   day: str | None = None, spread: int | None = None,
                   hold_ms: int = CLAIM_MS, merge_copies: bool = False) -> list[int]:
    """Export the `wanted` windows (`window_start`, `window_end`) that nobody has exported or is
    exporting; returns the windows that this run has published.

    The run claims its windows in the ledger `<root>/runs` first. Rows and rejects go below a folder of
    this attempt, `<root>/<config>/data/attempt=…`; one record of the ledger, written last, publishes
    both. Any number of runs may be started for the same windows: each window is published once. A run
    that dies holds its windows for `hold_ms`, then another takes them over; should it be alive after
    all, what it has written of them stays invisible. A failed attempt is recorded as such, its windows
    are free at once and its folder is removed.

    Only wanted windows are read, each once however often it is given; `time`, a column of epoch
    microseconds or a timestamp, decides on both the scan and the window. Copies of an insert id are
    removed within a window; rows without one all stay. `spread` is the number of tasks a window may
    be dealt over; by default four times the window's share of all shuffle partitions, or of the tasks
    that a large export has by its size. With
    `merge_copies`, an id that is sent very often does not come to one task row by row.
    """
    spark, attempt = logs.sparkSession, uuid.uuid4().hex
    journal = Journal(spark, f"{root}/runs", config.name)
    # A number for each window; rows stay where they are.
    asked = [r[0] for r in wanted.select("window_start").distinct().collect()]
    claimed = journal.claim(asked, attempt, hold_ms)
    if not claimed:
        return []
    runs = [run_of(config.name, w, config.window_ms) for w in claimed]
    try:
        scanned = log_source.scan_range(logs, claimed[0], claimed[-1] + config.window_ms, time, day)
        # Ahead of the extraction: a bad row of another window is none of this run's business.
        todo = spark.createDataFrame([(w,) for w in claimed], "window_start bigint")
        scanned = windows.assign_window(scanned, config.window_ms, time).join(
            todo, "window_start", "left_semi")
        found = outcomes(scanned, config, insert_id, time)
        written = tables.write_attempt(
            found, config, root, attempt, insert_id,
            spread or tables.spread_of(spark, len(claimed), tables.tasks_of(found)), claimed,
            merge_copies)
        done = journal.publish(attempt, [r | written.get(r["window_start"], {}) for r in runs])
    except Exception:
        if not journal.give_up(attempt, claimed, runs):
            return claimed
        delete_dir(spark, tables.data_path(root, config, attempt))
        raise
    journal.compact()
    return [r["window_start"] for r in done]
