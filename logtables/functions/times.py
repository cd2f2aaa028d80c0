"""Time alignment. Windows are epoch milliseconds, half-open, multiples of their length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(value: Column, multiple: int) -> Column:
    """Round toward zero to a multiple, in 64-bit integers."""
    return F.call_function("div", value, F.lit(multiple)) * F.lit(multiple).cast("bigint")


def window_start_ms(time_usec: Column, window_ms: int) -> Column:
    return align(F.call_function("div", time_usec, F.lit(1000)), window_ms)


def usec(ts: Column) -> Column:
    """Epoch microseconds of a timestamp, with or without zone, in the session zone."""
    return F.unix_micros(ts.cast("timestamp"))


def any_usec(rows: DataFrame, name: str) -> Column:
    """Epoch microseconds of a column that holds them or a timestamp."""
    kind = rows.schema[name].dataType
    return usec(F.col(name)) if isinstance(kind, T.TimestampType | T.TimestampNTZType) else F.col(
        name)


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def month_id(window_start: Column) -> Column:
    return F.date_format(F.timestamp_millis(window_start), "yyyyMM")


def next_month_id(window_start: Column) -> Column:
    return F.date_format(F.add_months(F.timestamp_millis(window_start), 1), "yyyyMM")
