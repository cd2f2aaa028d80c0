"""Row selection ahead of extraction."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The highest level of a request's lines, where it was stored (`sinks/logs.py`).
TOP_LEVEL = "top_level"
#: The longest list of versions that is written out as a predicate.
PUSHED_PAIRS = 20


def min_level(logs: DataFrame, level: int | None) -> DataFrame:
    """Keep requests with at least one log line at `level` or above; None keeps all.

    Logs that were stored with their TOP_LEVEL are filtered by that, a bare column that lets Parquet
    skip row groups. Otherwise the lines' levels are read, not their messages, in generated code.
    """
    if level is None:
        return logs
    if TOP_LEVEL in logs.columns:
        return logs.where(F.col(TOP_LEVEL) >= level)
    return logs.where(F.array_max(F.col("app_logs")["level"]) >= level)


def versions(logs: DataFrame, wanted: DataFrame | Sequence[tuple[str, str]] | None) -> DataFrame:
    """Keep requests served by the given (version, module) pairs; none given keeps all.

    A list of up to PUSHED_PAIRS becomes a pushed-down predicate. A longer one or a table becomes a
    semi join whose strategy is left to Spark.
    """
    if not isinstance(wanted, DataFrame):
        if not wanted:
            return logs
        if len(wanted) > PUSHED_PAIRS:
            wanted = logs.sparkSession.createDataFrame(
                list(wanted), "version_id string, module_id string")
    if isinstance(wanted, DataFrame):
        return logs.join(wanted, ["version_id", "module_id"], "left_semi")
    pairs = [(F.col("version_id") == v) & (F.col("module_id") == m) for v, m in wanted]
    return logs.where(reduce(lambda a, b: a | b, pairs))


def skip(logs: DataFrame, predicate: Column | str | None) -> DataFrame:
    """Drop requests for which the predicate is true; null counts as false."""
    if predicate is None:
        return logs
    predicate = F.expr(predicate) if isinstance(predicate, str) else predicate
    return logs.where(~F.coalesce(predicate, F.lit(False)))
