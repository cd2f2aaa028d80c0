"""Exact duplicates by a stream: keyed state on disk holds what was seen, bytes settle each hit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.llm.shared import folder, kept

#: State is kept by RocksDB and its local copy is dropped at each commit: an open store reserves
#: megabytes of disk for every partition, however little it holds.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: The id that stands for a null one.
LEAST = -(1 << 63)


def folded(text: str | Column = "text") -> Column:
    """A text as it is compared: A-Z lower-cased, null as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def consume(arrivals: DataFrame, state: str, checkpoint: str) -> None:
    """Run the stream over what has arrived; each batch appends the groups it changed to `state`.

    The state is keyed by digest and never expires: the largest id so far, the locator of its text
    and the number of rows. It is kept by RocksDB on disk and committed to `checkpoint`, so a
    restarted stream goes on where it stopped; a batch that is written again has the same values.
    """
    groups = arrivals.groupBy("digest").agg(
        F.max(F.struct("id", "locator")).alias("first"), F.sum("copies").alias("group_size"))

    def write(batch: DataFrame, number: int) -> None:
        (batch.withColumn("batch", F.lit(number)).write.mode("overwrite")
         .parquet(f"{state}/batch={number}"))

    conf = arrivals.sparkSession.conf
    before = {key: conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        conf.set(key, value)
    try:
        query = (groups.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
               digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Each row's group of equal texts: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal if identical after lower-casing A-Z; null is empty. The largest id of a group
    stays; a null id counts as the smallest. Rows that repeat an id and a text all count, and one
    of them is kept. Empty table: no rows. Other columns are not read.

    `docs` is read twice: for the digests, and for the bytes of hits, rows whose digest another row
    holds too. Whole texts are compared under each digest; where they differ, all of them are grouped
    by their bytes instead.
    """
    spark = docs.sparkSession
    place = folder(spark, "dedup")
    rows = docs.select(
        F.coalesce(F.col(id).cast("bigint"), F.lit(LEAST)).alias("id"), folded(text).alias("norm"),
        F.input_file_name().alias("locator")).withColumn("digest", digest(F.col("norm")))
    (rows.withColumn("sha", sha256(F.col("norm"))).groupBy("id", "digest", "sha")
     .agg(F.min("locator").alias("locator"), F.count("*").alias("copies"))
     .write.parquet(f"{place}/arrivals"))
    arrived = spark.read.parquet(f"{place}/arrivals")
    consume(spark.readStream.schema(arrived.schema).parquet(f"{place}/arrivals"),
            f"{place}/state", f"{place}/checkpoint")
    members = arrived.join(seen(spark, f"{place}/state"), "digest")
    settled = members.select("id", "keep_id", "group_size", "sha", "copies")
    wrong = kept(differing(rows))
    if not wrong.isEmpty():
        settled = members.join(wrong, "digest", "left_anti").select(
            *settled.columns).unionByName(regrouped(rows, wrong))
    each = settled.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
                          .alias("copy"))
    real = [F.when(F.col(c) != LEAST, F.col(c)) for c in ("id", "keep_id")]
    return each.select(
        real[0].alias(id), real[1].alias("keep_id"), "group_size",
        ((F.col("id") == F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def seen(spark: SparkSession, state: str) -> DataFrame:
    """The last value of each key of the state: (digest, keep_id, keep_locator, group_size)."""
    last = spark.read.parquet(state).groupBy("digest").agg(
        F.max(F.struct("batch", "first", "group_size")).alias("last"))
    return last.select("digest", F.col("last.first.id").alias("keep_id"),
                       F.col("last.first.locator").alias("keep_locator"),
                       F.col("last.group_size").alias("group_size"))


def differing(rows: DataFrame) -> DataFrame:
    """(digest): those under which bytes differ.

    Texts are grouped by digest and whole text, which compares the bytes of every hit. Copies are
    merged before they move, so each task passes a text on once, however many copies it has.
    """
    return rows.select("digest", "norm").distinct().groupBy("digest").agg(
        F.count("*").alias("texts")).where("texts > 1").select("digest")


def regrouped(rows: DataFrame, wrong: DataFrame) -> DataFrame:
    """The rows under digests that do not tell their texts apart, grouped by their bytes."""
    again = kept(rows.join(wrong, "digest", "left_semi").select("id", "norm"))
    by_bytes = again.groupBy("norm").agg(
        F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    return (again.groupBy("id", "norm").agg(F.count("*").alias("copies"))
            .join(by_bytes, "norm")
            .select("id", "keep_id", "group_size", sha256(F.col("norm")).alias("sha"), "copies"))
