"""The snapshot export: back up, wait for the handle, load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from logtables.sinks import snapshots
from logtables.sources import backups
from logtables.spec import SnapshotConfig


def start(spark: SparkSession, entities: Mapping[str, DataFrame], config: SnapshotConfig,
          timestamp_ms: int) -> list[str]:
    """Back up the kinds and, unless the configuration says otherwise, load them."""
    snapshots.back_up(spark, entities, config, timestamp_ms)
    return [] if config.skip_load else load_if_ready(spark, config, timestamp_ms)


def load_if_ready(spark: SparkSession, config: SnapshotConfig, timestamp_ms: int) -> list[str]:
    """Load the backup of this timestamp. An empty list means not ready: call again later."""
    found = backups.ready(backups.find_backup(
        snapshots.read_catalogue(spark, config), timestamp_ms, config.name_prefix)).first()
    return snapshots.load(spark, config, found.gs_handle, timestamp_ms) if found else []
