"""Size-bounded batches on a live stream: the open batch of each group goes on in the next micro-batch.

A micro-batch is numbered like any table (`operators/batching.py`), from the bytes and the number that
the rows before it have left open. That is a row per group, written beside the numbered rows under the
number of the micro-batch; one that runs again starts from the same state and replaces its own files.
Rows of a group have to arrive in its order, as those of a log do; a hot group spreads over slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logtables.operators import batching
from logtables.session import delete_dir, list_dir
from logtables.spec import MAX_BATCH_BYTES
from logtables.streaming.export import EVERY_MINUTE


def _folder(root: str, part: str, batch_id: int) -> str:
    return f"{root}/{part}/micro={batch_id}"


def write_batch(root: str, group: Sequence[str], order: Sequence[str], size: str,
                limit: int = MAX_BATCH_BYTES, slices: int | None = None):
    """Number the rows of one micro-batch and write them and the state after it."""

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        known = sorted(int(n.split("=")[1]) for n in list_dir(spark, f"{root}/state")
                       if int(n.split("=")[1]) < batch_id)
        fields = [rows.schema[c] for c in group] + [
            T.StructField(c, T.LongType()) for c in ("open_bytes", "batch")]
        carried = spark.read.schema(T.StructType(fields)).parquet(
            _folder(root, "state", known[-1])) if known else None
        found = batching.byte_batches(rows, group, order, size, limit, slices, carried)
        found.write.mode("overwrite").parquet(_folder(root, "rows", batch_id))
        written = spark.read.schema(found.schema).parquet(_folder(root, "rows", batch_id))
        batching.left_open(written, group, size, carried).write.mode("overwrite").parquet(
            _folder(root, "state", batch_id))
        # The last two: a batch that runs again needs the state before it.
        for old in known[:-1]:
            delete_dir(spark, _folder(root, "state", old))

    return write


def start_batches(rows: DataFrame, root: str, checkpoint: str, group: Sequence[str],
                  order: Sequence[str], size: str, limit: int = MAX_BATCH_BYTES,
                  trigger: dict | None = None, slices: int | None = None) -> StreamingQuery:
    """Start numbering a stream; `read_batches` shows the numbered rows."""
    return (rows.writeStream.foreachBatch(write_batch(root, group, order, size, limit, slices))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_MINUTE)).start())


def read_batches(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of the finished micro-batches (those with a state after them) with their `batch`."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    last = max((int(n.split("=")[1]) for n in list_dir(spark, f"{root}/state")), default=-1)
    paths = [f"{root}/rows/{n}" for n in sorted(list_dir(spark, f"{root}/rows"))
             if int(n.split("=")[1]) <= last]
    return spark.read.schema(full).parquet(*paths) if paths else spark.createDataFrame([], full)
