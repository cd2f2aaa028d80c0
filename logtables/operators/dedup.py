"""One row per insert id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(rows: DataFrame, key: str | Sequence[str] | None = "requestId",
          first_by: Sequence[str] = ()) -> DataFrame:
    """Keep one copy per key; without a key nothing is dropped.

    Both forms aggregate before the shuffle, so a key repeated very often reaches the reducer at
    most once per input partition. With `first_by` the survivor is the least row by those columns,
    the remaining columns breaking ties, so a re-run keeps the same copy; without it the copies are
    taken to be equal.
    """
    if key is None:
        return rows
    keys = [key] if isinstance(key, str) else list(key)
    if not first_by:
        return rows.dropDuplicates(keys)
    rest = [c for c in rows.columns if c not in keys and c not in first_by]
    survivor = F.min(F.struct(*first_by, *rest)).alias("_row")
    return rows.groupBy(*keys).agg(survivor).select(*[
        F.col(c) if c in keys else F.col(f"_row.{c}") for c in rows.columns])
