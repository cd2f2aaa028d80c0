"""Export windows: planning, assignment, lateness, and which are still to be run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.functions import times
from logtables.spec import RUN_DELAY_MS, WINDOWS_PER_TRIGGER


def trigger_at(spark: SparkSession, now_ms: int) -> DataFrame:
    return spark.range(1).select(F.lit(now_ms).cast("bigint").alias("now_ms"))


def plan_windows(triggers: DataFrame, window_ms: int, count: int = WINDOWS_PER_TRIGGER,
                 delay_ms: int = RUN_DELAY_MS) -> DataFrame:
    """Windows each trigger (`now_ms`) plans: the last complete one and those after it.

    A window planned by several triggers appears once.
    """
    first = (times.align(F.col("now_ms"), window_ms) - window_ms).alias("first")
    starts = F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<bigint>")).alias("i")
    start = F.col("first") + F.col("i") * window_ms
    return (triggers.select(first).distinct()
            .select("first", starts)
            .select(start.alias("window_start")).distinct()
            .select("window_start",
                    (F.col("window_start") + window_ms).alias("window_end"),
                    (F.col("window_start") + window_ms + delay_ms).alias("runnable_ms")))


def pending_windows(planned: DataFrame, runs: DataFrame, config: str) -> DataFrame:
    """Planned windows without a finished run of this configuration."""
    done = (runs.where((F.col("config") == config) & (F.col("status") == "done"))
            .select("window_start", "window_end"))
    return planned.join(done, ["window_start", "window_end"], "left_anti")


def due_windows(windows: DataFrame, at_ms: int) -> DataFrame:
    return windows.where(F.col("runnable_ms") <= at_ms)


def assign_window(logs: DataFrame, window_ms: int, time: str = "start_time_usec") -> DataFrame:
    """Add the window of `time`, a column in epoch microseconds or a timestamp."""
    start = times.window_start_ms(times.any_usec(logs, time), window_ms)
    return logs.withColumns({"window_start": start, "window_end": start + window_ms})


def _in_time(window_ms: int, delay_ms: int, time: str, arrival: str) -> Column:
    end = times.window_start_ms(F.col(time), window_ms) + (window_ms + delay_ms)
    return F.col(arrival) <= end * 1000


def on_time(logs: DataFrame, window_ms: int, delay_ms: int = RUN_DELAY_MS,
            time: str = "start_time_usec", arrival: str = "arrival_usec") -> DataFrame:
    """Rows visible when their window is read, `delay_ms` after it ends."""
    return logs.where(_in_time(window_ms, delay_ms, time, arrival))


def late(logs: DataFrame, window_ms: int, delay_ms: int = RUN_DELAY_MS,
         time: str = "start_time_usec", arrival: str = "arrival_usec") -> DataFrame:
    """The complement: rows their window's export never sees."""
    return logs.where(~F.coalesce(_in_time(window_ms, delay_ms, time, arrival), F.lit(False)))
