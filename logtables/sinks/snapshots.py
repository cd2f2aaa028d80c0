"""Entity snapshots: back up kinds, publish the backup, load it into tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.functions import keys
from logtables.session import delete_dir
from logtables.sinks import vacuum
from logtables.sinks.journal import Journal
from logtables.sinks.tables import quoted
from logtables.sources.backups import catalogue_path, read_catalogue, read_kind
from logtables.sources.runs import DONE, FAILED
from logtables.spec import SnapshotConfig

# Kinds written or loaded at the same time; each is a distributed job of its own.
CONCURRENT_KINDS = 4


def _each_kind(spark: SparkSession, work, kinds) -> None:
    with ThreadPoolExecutor(min(CONCURRENT_KINDS, len(kinds))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(work), kind) for kind in kinds]:
            done.result()


def back_up(spark: SparkSession, entities: Mapping[str, DataFrame], config: SnapshotConfig,
            timestamp_ms: int) -> str:
    """Write every kind, then one catalogue row with the handle: a handle means complete.

    Each attempt writes to a folder of its own, so a finished backup stays as it is whatever
    happens to a later one of the same name. Of several finished ones the first counts.
    """
    day = datetime.fromtimestamp(timestamp_ms / 1000, UTC).strftime("%Y_%m_%d")
    name = keys.backup_name(timestamp_ms, config.name_prefix) + day
    handle = f"{config.root}/{name}/{uuid.uuid4().hex}/backup_info"
    if "/gs/" in handle or handle.count("backup_info") != 1:
        raise ValueError(f"cannot tell the kinds apart below {handle}")

    def write(kind: str) -> None:
        entities[kind].write.parquet(keys.kind_uri_text(handle, kind))

    _each_kind(spark, write, config.kinds)
    (spark.range(0, 1, 1, 1).select(
        F.lit(name).alias("name"), F.unix_millis(F.current_timestamp()).alias("complete_time"),
        F.lit(handle).alias("gs_handle"), F.lit(uuid.uuid4().hex).alias("record"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("record").parquet(catalogue_path(config)))
    return handle


def load(spark: SparkSession, config: SnapshotConfig, handle: str, timestamp_ms: int,
         fmt: str = "parquet", **options: str) -> list[str]:
    """Load every kind into its table and return the tables.

    A kind is first written whole to a new folder, then the table, a view of that folder, is
    replaced in one step, with other columns if need be. A failed load leaves the table on its old
    data. Each load is recorded in the ledger, failed ones too. What a load has replaced stays for
    `config.keep_replaced_ms`, for queries that have begun before, and goes with a later load.
    """
    stamp = timestamp_ms if config.append_timestamp else None
    tables = {kind: keys.kind_table(kind, stamp) for kind in config.kinds}

    def load_kind(kind: str) -> None:
        table = tables[kind]
        folder = f"{config.root}/tables/{table}/{uuid.uuid4().hex}"
        try:
            read_kind(spark, handle, kind, fmt, **options).write.parquet(folder)
            loaded = spark.read.parquet(folder)
            count = loaded.count()
            point_table(spark, quoted(config.database, table), folder)
        except Exception:
            delete_dir(spark, folder)
            _record(spark, config, table, timestamp_ms, 0, FAILED, None)
            raise
        _record(spark, config, table, timestamp_ms, count, DONE, folder)
        vacuum.replaced_loads(spark, config, table)

    _each_kind(spark, load_kind, config.kinds)
    return [f"{config.database}.{table}" for table in tables.values()]


def _record(spark: SparkSession, config: SnapshotConfig, table: str, timestamp_ms: int,
            count: int, status: str, location: str | None) -> None:
    run = {"run_id": f"load_{table}_{timestamp_ms}", "window_start": timestamp_ms,
           "window_end": timestamp_ms, "row_count": count}
    Journal(spark, f"{config.root}/runs", table).append(location, [run], status)


def point_table(spark: SparkSession, name: str, folder: str) -> None:
    """Let a table show what is in `folder`. The name, quoted, is that of a view, so the switch is
    one change in the catalogue and there is no moment without the table."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.{quoted(folder)}")
