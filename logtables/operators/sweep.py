"""Range lookups by a sorted sweep: for many starts at once, the first point at or after each.

Starts and points are sorted together and dealt out by ranges, so no key has to fit one task. A range
is swept once, from its end: each start takes the last point seen. What a range cannot answer is the
first point of a later range, of which there is one row per range. There is no pair of a start and a
point before the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtables.session import durable


def next_points(starts: DataFrame, points: DataFrame, key: str, ties: Sequence[str] = ()
                ) -> DataFrame:
    """Each distinct start (`key`) with the first point at or after it, as a struct `point` of the
    points' columns; null if there is none.

    Points are in order of `key`, then of `ties`, nulls first. Rows without a key take no part.
    """
    value = F.struct(*[F.col(c) for c in points.columns])
    at = points.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.lit(1).alias("_kind"),
        *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)], value.alias("_point"))
    kinds = dict(at.dtypes)
    asked = starts.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct().select(
        "_key", F.lit(0).alias("_kind"),
        *[F.lit(None).cast(kinds[c]).alias(c) for c in [*at.columns[2:-1], "_point"]])
    order = ["_key", "_kind", *at.columns[2:-1]]
    # Written once: where a row lies and which range that is stay as they are.
    placed = durable(at.unionAll(asked).repartitionByRange(*order).withColumn(
        "_range", F.spark_partition_id()))
    back = Window.partitionBy("_range").orderBy(*[F.desc_nulls_last(c) for c in order])
    swept = placed.select("_range", "_key", "_kind", F.last("_point", ignorenulls=True).over(
        back.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_here"))
    heads = swept.where("_kind = 1").groupBy("_range").agg(F.min(F.struct("_key", "_here")).alias(
        "_head")).select("_range", F.col("_head._here").alias("_first"))
    # As few rows as there are ranges.
    ranges = placed.select("_range").distinct().join(heads, "_range", "left")
    later = ranges.select("_range", F.last("_first", ignorenulls=True).over(
        Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)).alias("_then"))
    return swept.where("_kind = 0").join(later, "_range").select(
        F.col("_key").alias(key), F.coalesce("_here", "_then").alias("point"))
