"""Reports over exports: counts per window, reject reasons, over-size diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.operators.rows import OVERSIZE


def rows_per_window(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_start").agg(F.count("*").alias("row_count"))


def reject_reason_counts(rejects: DataFrame) -> DataFrame:
    reason = F.concat(F.col("reason"), F.lit("~"), F.col("message"))
    return rejects.groupBy(reason.alias("reason")).agg(F.count("*").alias("error_count"))


def oversize_field_lengths(rejects: DataFrame) -> DataFrame:
    """One row per field of every over-size row, with its length and the row's path."""
    big = rejects.where(F.col("reason") == OVERSIZE)
    # The outer form: a filter inferred from the inner one would be pushed below the projection.
    fields = big.select("request_id", "path", F.explode_outer("field_lengths").alias("field", "chars"))
    return fields.where(F.col("field").isNotNull())
