"""Removal of what nothing points to: folders of attempts that died, and of loads that were replaced.

What is published is decided by the ledger and the catalogue of backups. Everything else goes once it
is older than a time of grace, which is to be longer than a run or a query takes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtables.session import delete_dir, list_dir
from logtables.sinks.journal import Journal, now_ms
from logtables.sources.backups import catalogue_path, read_catalogue
from logtables.sources.runs import DONE, WRITTEN, read_runs
from logtables.spec import LogExportConfig, SnapshotConfig

#: Folders of a snapshot export that hold no backup.
KEPT = ("catalogue", "runs", "tables")


def _unnamed(spark: SparkSession, folders: dict[str, int], named: DataFrame, grace_ms: int,
             alive: Iterable[str] = ()) -> list[str]:
    """Of folders with the time they were changed, the old ones that `named` does not have."""
    old = [(name,) for name, changed in folders.items()
           if changed <= now_ms() - grace_ms and name not in set(alive)]
    listed = spark.createDataFrame(old, "folder string")
    return sorted(r[0] for r in listed.join(
        named.toDF("folder").distinct(), "folder", "left_anti").collect())


def attempts(spark: SparkSession, root: str, config: LogExportConfig, grace_ms: int) -> list[str]:
    """Remove folders of attempts that no finished run points to and that hold no claim any more."""
    data = f"{root}/{config.name}/data"
    state = Journal(spark, f"{root}/runs", config.name).state()
    alive = {f"attempt={who}" for who, until in state.claims.values() if until > now_ms()}
    done = read_runs(spark, f"{root}/runs", config.name).where(F.col("status").isin(DONE, WRITTEN))
    gone = _unnamed(spark, {n: t for n, t in list_dir(spark, data).items()
                            if n.startswith("attempt=")},
                    done.where("location IS NOT NULL").select(
                        F.concat(F.lit("attempt="), "location")), grace_ms, alive)
    for name in gone:
        delete_dir(spark, f"{data}/{name}")
    return gone


def replaced_loads(spark: SparkSession, config: SnapshotConfig, table: str,
                   grace_ms: int | None = None) -> list[str]:
    """Remove folders of a table which a later load replaced that long ago; returns them."""
    grace_ms = config.keep_replaced_ms if grace_ms is None else grace_ms
    done = read_runs(spark, f"{config.root}/runs", table).where(F.col("status") == DONE)
    by_load = Window.partitionBy("config").orderBy("record")
    old = done.withColumn("replaced_ms", F.lead("recorded_ms").over(by_load)).where(
        F.col("replaced_ms") <= now_ms() - grace_ms)
    there = list_dir(spark, f"{config.root}/tables/{table}")
    gone = sorted(r[0] for r in old.select("location").distinct().collect()
                  if r[0].rsplit("/", 1)[1] in there)
    for folder in gone:
        delete_dir(spark, folder)
    return gone


def backups(spark: SparkSession, config: SnapshotConfig, grace_ms: int) -> list[str]:
    """Remove folders of backups that were never finished: the catalogue has no handle below them."""
    found = {f"{name}/{attempt}": changed for name in list_dir(spark, config.root)
             if name not in KEPT
             for attempt, changed in list_dir(spark, f"{config.root}/{name}").items()}
    if list_dir(spark, catalogue_path(config)):
        handles = read_catalogue(spark, config).where("gs_handle IS NOT NULL").select(
            F.regexp_extract("gs_handle", "([^/]+/[^/]+)/backup_info$", 1))
    else:
        handles = spark.createDataFrame([], "handle string")
    gone = _unnamed(spark, found, handles, grace_ms)
    for folder in gone:
        delete_dir(spark, f"{config.root}/{folder}")
    return gone
