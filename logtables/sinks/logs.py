"""Request logs stored for exports: by day, and within a day by level and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.functions import times
from logtables.operators.filters import TOP_LEVEL

#: Bytes of a row group. Level and time are clustered, so a group spans little of either.
ROW_GROUP = 16 << 20


def store(logs: DataFrame, path: str, time: str = "start_time_usec", row_group: int = ROW_GROUP
          ) -> None:
    """Write logs below `day=…` folders with the highest level of their lines (null without lines).

    A day is dealt over as many tasks as its size asks for. Within a file rows are in order of level,
    then of time, so the statistics of row groups rule out levels as well as spans of time.
    """
    day = F.to_date(F.timestamp_micros(times.any_usec(logs, time)))
    (logs.withColumns({TOP_LEVEL: F.array_max(F.col("app_logs")["level"]), "day": day})
     .hint("rebalance", "day").sortWithinPartitions("day", TOP_LEVEL, time)
     .write.mode("overwrite").option("parquet.block.size", row_group)
     .partitionBy("day").parquet(path))
