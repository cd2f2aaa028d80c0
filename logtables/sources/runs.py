"""The run ledger: what was run, how it ended, how many rows it wrote and where they are.

Each configuration has a journal (`sinks/journal.py`): a checkpoint, which is a Parquet folder sorted by
run id, and the records after it. Reading opens the checkpoint's files, as far as statistics do not rule
them out, and a bounded number of small records, however many runs there were.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.session import list_dir, read_file

RUNS_COLUMNS = ["run_id", "config", "window_start", "window_end", "row_count", "status"]
#: As stored: the configuration is in the path. `location` is the attempt, `whole` tells whether all
#: windows of the attempt are published, `record` is the number of the journal's record.
RUNS_SCHEMA = T.StructType([T.StructField(name, kind()) for name, kind in (
    ("run_id", T.StringType), ("window_start", T.LongType), ("window_end", T.LongType),
    ("row_count", T.LongType), ("reject_count", T.LongType), ("table_id", T.StringType),
    ("status", T.StringType), ("location", T.StringType), ("whole", T.BooleanType),
    ("recorded_ms", T.LongType), ("record", T.LongType))])
RUN_NAMES = RUNS_SCHEMA.names
#: WRITTEN: rows of a window that a stream has not closed yet. LATE: rows that came after that.
DONE, FAILED, WRITTEN, LATE = "done", "failed", "written", "late"
RECORD, CHECKPOINT = "{:020d}.json", "{:020d}.checkpoint"


def numbered(name: str) -> int:
    return int(name.split(".")[0])


def latest(names) -> tuple[str | None, list[str]]:
    """Of the files of a journal the last checkpoint, and the records after it in their order."""
    base = max((n for n in names if n.endswith(".checkpoint")), default=None)
    after = numbered(base) if base else -1
    return base, sorted(n for n in names if n.endswith(".json") and not n.startswith(".")
                        and numbered(n) > after)


def read_config(spark: SparkSession, folder: str, config: str) -> DataFrame:
    """All records of one configuration."""
    while True:
        names = list_dir(spark, folder)
        base, records = latest(names)
        try:
            read = [json.loads(read_file(spark, f"{folder}/{name}")) for name in records]
            rows = [tuple(run[c] for c in RUN_NAMES) for record in read
                    if record["kind"] == "runs" for run in record["runs"]]
            found = spark.createDataFrame(rows, RUNS_SCHEMA)
            if base:
                kept = json.loads(read_file(spark, f"{folder}/{base}"))["folder"]
                found = spark.read.schema(RUNS_SCHEMA).parquet(f"{folder}/{kept}").unionAll(found)
            return found.withColumn("config", F.lit(config))
        except Exception:
            # A checkpoint has taken the place of a listed record.
            if list_dir(spark, folder).keys() >= names.keys():
                raise


def read_runs(spark: SparkSession, path: str, config: str | None = None,
              span: tuple[int, int] | None = None) -> DataFrame:
    """All records, or those of one configuration, of the windows that start in a span if given."""
    configs = [n.split("=", 1)[1] for n in sorted(list_dir(spark, path)) if n.startswith("config=")]
    found = None
    for name in configs if config is None else [config]:
        runs = read_config(spark, f"{path}/config={name}", name)
        found = runs if found is None else found.unionAll(runs)
    if found is None:
        found = spark.createDataFrame([], RUNS_SCHEMA).withColumn("config", F.lit(""))
    return found.where(F.col("window_start").between(*span)) if span else found


def list_runs(runs: DataFrame) -> DataFrame:
    """The last record of each run."""
    last = F.max(F.struct("record", *RUNS_COLUMNS[1:])).alias("last")
    return runs.groupBy("run_id").agg(last).select(
        "run_id", *[F.col(f"last.{c}") for c in RUNS_COLUMNS[1:]])


def run_by_id(runs: DataFrame, run_id: str) -> DataFrame:
    """The run with this id; no rows if there is none."""
    return list_runs(runs.where(F.col("run_id") == run_id))


def find_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The run with this id, looked up where it can be: a run id names its configuration, and the
    files of a checkpoint are sorted by it."""
    configs = [n.split("=", 1)[1] for n in sorted(list_dir(spark, path))]
    found = [read_runs(spark, path, c) for c in configs if f"{c}_" in run_id]
    runs = found[0] if found else read_runs(spark, path, "")
    for more in found[1:]:
        runs = runs.unionAll(more)
    return run_by_id(runs, run_id)


def published(runs: DataFrame) -> DataFrame:
    """Where the rows of finished runs are: (attempt, window_start)."""
    return runs.where(F.col("status") == DONE).select(
        F.col("location").alias("attempt"), "window_start").distinct()
