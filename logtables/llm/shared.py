"""Shared folders, checkpoints and ranks used by the operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtables.session import shared_root


#: Bytes of a batch that is handed to Python, whatever the number and length of its rows; one
#: longer text is a batch of its own.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, after bounding the session's Arrow batches by bytes: texts differ in length a
    thousandfold, so a number of rows bounds nothing."""
    df.sparkSession.conf.set(*BATCH)
    return df


def root(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Where it is unset, as in small tests, a folder below the warehouse takes its place; on a cluster a
    warehouse in a local folder is refused.
    """
    return shared_root(spark)


def folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{root(spark)}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder; lineage ends there. Its partitions stay as they are."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root(spark))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished passes.

    It does so once the driver has collected the frames that made them, which may otherwise happen
    long after; until then they take up the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; none for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add `name`: the rank (bigint, gapless from 0) of each row in its group by `order`.

    No group has to fit one task: rows are dealt out by ranges of (group, order), each range ranks
    its own rows and starts at the number of rows that ranges before it hold. Per range and group
    one count is kept, so the running sums are over few rows. Rows equal in `order` have ranks of
    which each gets one. `df` is read several times and should be cheap or checkpointed.
    """
    dealt = kept(df.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = dealt.groupBy(group, "_range").agg(F.count("*").alias("_n")).select(
        F.col(group).alias("_group"), F.col("_range").alias("_in"),
        F.coalesce(F.sum("_n").over(before.partitionBy(F.col(group))), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range", group).orderBy(*order)) - 1
    joined = dealt.withColumn("_row", within).join(
        starts, (F.col("_range") == F.col("_in")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(name, (F.col("_start") + F.col("_row")).cast("bigint")).drop(
        "_range", "_in", "_group", "_start", "_row", "_n")
