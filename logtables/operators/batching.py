"""Size-bounded batches in row order.

The rule is greedy: rows are added until the next one would take the batch above the limit, then a
new batch starts with that row. Where a batch ends depends on every row before it, so a group looks
sequential. It is cut up here without changing the result:

1. Rows are range-partitioned by (group, order). A large group spreads over as many slices as its
   size asks for; every slice is a contiguous run in order.
2. Each slice that lies wholly inside one group is reduced to a *transfer*: a small table that maps
   the bytes already in the open batch on entry to (batches closed, bytes in the open batch on
   exit). Only the rows within one limit of the slice's start can be the first cut, which bounds it;
   rows are taken in batch by batch, the transfers of the batches composed.
3. The slices of a group form a chain. Chains are walked in parallel, each in the order of its
   slices, a few summaries in memory at a time; that gives every slice its state on entry.
4. Every slice then numbers its own rows in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.operators import greedy
from logtables.session import durable
from logtables.spec import MAX_BATCH_BYTES

SUMMARY = T.StructType([
    T.StructField("slice", T.IntegerType()),
    T.StructField("group", T.StringType()),
    T.StructField("starts", T.BooleanType()),
    T.StructField("total", T.LongType()),
    T.StructField("upto", T.ArrayType(T.LongType())),
    T.StructField("closed", T.ArrayType(T.LongType())),
    T.StructField("open_bytes", T.ArrayType(T.LongType())),
    T.StructField("carry_bytes", T.LongType()),
    T.StructField("carry_batch", T.LongType()),
])

ENTRY = T.StructType([
    T.StructField("slice", T.IntegerType()),
    T.StructField("entry_bytes", T.LongType()),
    T.StructField("entry_batch", T.LongType()),
])


#: Bytes to a slice, by `estimated_size`, when the number of slices is not given.
SLICE_BYTES = 64 << 20
#: There are no more slices than this, whatever the input: what is broadcast, a row of three numbers
#: for each, stays below some 30 MB.
MOST_SLICES = 1_000_000
#: Group values as text that keeps every bit of a time.
LOSSLESS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def byte_batches(rows: DataFrame, group: Sequence[str], order: Sequence[str], size: str,
                 limit: int = MAX_BATCH_BYTES, slices: int | None = None,
                 carried: DataFrame | None = None) -> DataFrame:
    """Add `batch`, the number of the batch a row falls into within its group, counted from 0.

    `order` must be total within a group (end it with a unique id): ties cannot be split. Give only
    the columns the batches are needed for; the rows are written once to the shared folder, where
    `spark.cleaner.referenceTracking.cleanCheckpoints` removes them after use. A first row above
    the limit leaves batch 0 empty, so a batch number is not always used. The number of slices
    follows `estimated_size` of the input unless given; no job counts rows. `carried` has what earlier rows of a group have left:
    the group's columns, `open_bytes` and `batch`, as `left_open` gives them.
    """
    slices = min(slices or estimated_slices(rows), MOST_SLICES)
    columns = rows.columns
    before, carry = rows, []
    if carried is not None:
        carry = ["_carry_bytes", "_carry_batch"]
        first = (F.lit(greedy.FIRST_BATCH_BYTES).cast("bigint"), F.lit(0).cast("bigint"))
        state = carried.select(*[F.col(c).alias(f"_of_{c}") for c in group], "open_bytes",
                               F.col("batch").alias("_batch"))
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]
        before = rows.join(state, reduce(Column.__and__, same), "left").select(
            *columns, F.coalesce("open_bytes", first[0]).alias("_carry_bytes"),
            F.coalesce("_batch", first[1]).alias("_carry_batch"))
    placed = durable(
        before.repartitionByRange(slices, *group, *order)
        .sortWithinPartitions(*group, *order)
        .select("*", F.to_json(F.struct(*group), LOSSLESS).alias("_group"),
                F.col(size).cast("bigint").alias("_size"),
                F.spark_partition_id().alias("_slice")))
    # A row or two per slice: for the group it begins in and for the one it ends in.
    entries = (placed.select("_group", "_size", "_slice", *carry)
               .mapInArrow(greedy.summarize_slice(limit), SUMMARY)
               .repartition("group").sortWithinPartitions("group", "slice")
               .mapInPandas(greedy.walk_slices(limit), ENTRY))
    out = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])
    return (placed.join(F.broadcast(entries.withColumnRenamed("slice", "_slice")), "_slice", "left")
            .select(*columns, "_group", "_size", *carry, "entry_bytes", "entry_batch")
            .mapInArrow(greedy.number_slice(limit, columns), out))


def estimated_slices(rows: DataFrame) -> int:
    """At least one for each core; of an input whose size is unknown, as that of a join or an RDD, at
    least one for each shuffle partition."""
    spark = rows.sparkSession
    size, known = estimated_size(rows._jdf.queryExecution().optimizedPlan())
    least = spark.sparkContext.defaultParallelism
    if not known:
        least = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-size // SLICE_BYTES))


def estimated_size(plan) -> tuple[int, bool]:
    """Bytes of a plan's rows by the planner's estimates, and whether these are more than a guess.

    Without statistics of columns the planner takes the product of both sides for the size of a join,
    terabytes for two tables of some megabytes. Here a join is as large as its sides together, and other
    operators change the size as the planner says. Of an RDD it knows nothing (0 bytes here).
    """
    parts = [plan.children().apply(i) for i in range(plan.children().size())]
    own = int(str(plan.stats().sizeInBytes()))
    if not parts:
        known = plan.getClass().getSimpleName() != "LogicalRDD"
        return (own if known else 0), known
    found = [estimated_size(part) for part in parts]
    size, known = sum(n for n, _ in found), all(k for _, k in found)
    if len(parts) == 1:
        return size * own // max(1, int(str(parts[0].stats().sizeInBytes()))), known
    return min(size, own), known and own <= size


def left_open(batched: DataFrame, group: Sequence[str], size: str,
              carried: DataFrame | None = None) -> DataFrame:
    """What numbered rows leave open: (group, open_bytes, batch), the last batch of each group and the
    bytes counted for it. Groups of `carried` without new rows stay as they are."""
    fresh = F.lit(greedy.FIRST_BATCH_BYTES).cast("bigint")
    sums = batched.groupBy(*group, "batch").agg(F.sum(size).cast("bigint").alias("open_bytes"))
    if carried is None:
        sums = sums.withColumn("open_bytes", F.col("open_bytes") + F.when(
            F.col("batch") == 0, fresh).otherwise(0))
    else:
        # The batch that was open has the bytes it had; of a new group, the first ones.
        known = carried.select(*group, F.col("batch").alias("_batch"),
                               F.col("open_bytes").alias("_open"))
        both = sums.alias("s").join(known.alias("k"), reduce(Column.__and__, [
            F.col(f"s.`{c}`").eqNullSafe(F.col(f"k.`{c}`")) for c in group]), "full")
        had = F.coalesce("_batch", F.lit(0)) == F.col("batch")
        sums = both.select(
            *[F.coalesce(f"s.`{c}`", f"k.`{c}`").alias(c) for c in group],
            F.when(F.col("batch").isNull(), F.col("_open")).otherwise(
                F.col("open_bytes") + F.when(had, F.coalesce("_open", fresh)).otherwise(0))
            .alias("open_bytes"), F.coalesce("batch", "_batch").alias("batch"))
    last = F.max(F.struct("batch", "open_bytes")).alias("_last")
    return sums.groupBy(*group).agg(last).select(*group, "_last.open_bytes", "_last.batch")


def batch_sizes(batched: DataFrame, group: Sequence[str], size: str) -> DataFrame:
    return batched.groupBy(*group, "batch").agg(
        F.count("*").alias("row_count"), F.sum(size).cast("bigint").alias("total_bytes"))
