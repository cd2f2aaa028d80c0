"""Request logs: time-range scan and nested application log lines."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = datetime(1970, 1, 1)


def _bound(ms: int, dtype: T.DataType) -> Column:
    """A literal of the stored column's own type, so the comparison needs no cast and is pushed."""
    at = EPOCH + timedelta(milliseconds=ms)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(at.replace(tzinfo=UTC))
    return F.lit(ms * 1000).cast("bigint")


def scan_range(logs: DataFrame, start_ms: int, end_ms: int, time: str = "start_time_usec",
               day: str | None = None) -> DataFrame:
    """Rows with `start_ms <= time < end_ms`.

    `time` is a stored column in epoch microseconds or a timestamp; comparing it bare lets Parquet
    skip row groups. `day` names a date partition column, if the table has one, to prune by.
    """
    dtype = logs.schema[time].dataType
    c = F.col(time)
    kept = logs.where((c >= _bound(start_ms, dtype)) & (c < _bound(end_ms, dtype)))
    if day:
        first = (EPOCH + timedelta(milliseconds=start_ms)).date()
        last = (EPOCH + timedelta(milliseconds=max(end_ms - 1, start_ms))).date()
        kept = kept.where(F.col(day).between(F.lit(first), F.lit(last)))
    return kept


def app_log_lines(logs: DataFrame) -> DataFrame:
    """One row per log line; a request without lines keeps one row with nulls."""
    return (logs.select("request_id", F.posexplode_outer("app_logs").alias("line", "entry"))
            .select("request_id", "line", "entry.level", "entry.message"))
