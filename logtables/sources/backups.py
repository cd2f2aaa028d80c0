"""The backup catalogue and the files of a backup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.functions import keys
from logtables.operators import sweep
from logtables.spec import SnapshotConfig

BACKUP_INFO_SCHEMA = "name string, complete_time bigint, gs_handle string"


def catalogue_path(config: SnapshotConfig) -> str:
    return f"{config.root}/catalogue"


def read_catalogue(spark: SparkSession, config: SnapshotConfig) -> DataFrame:
    found = spark.read.schema(f"{BACKUP_INFO_SCHEMA}, record string")
    return found.parquet(catalogue_path(config)).drop("record")


def find_backup(backup_info: DataFrame, timestamp_ms: int, prefix: str | None) -> DataFrame:
    """First backup by name whose name starts with the expected one.

    The upper bound is the name followed by `Z`, so a name that goes on with a character above it
    (a lower-case letter, for one) is not found.
    """
    name = keys.backup_name(timestamp_ms, prefix)
    return (backup_info.where(F.col("name").between(name, name + "Z"))
            .orderBy("name", "complete_time", "gs_handle").limit(1))


def find_backups(backup_info: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The first backup by name for each of many prefixes (`prefix`) at once.

    One row per distinct prefix, with nulls where no name lies between the prefix and the prefix
    followed by `Z`. Prefixes may overlap. The first name at or after a prefix is in that range if any
    name is, so one sorted sweep over names and prefixes answers all of them.
    """
    names = backup_info.select("name", "complete_time", "gs_handle")
    found = sweep.next_points(prefixes.select(F.col("prefix").alias("name")), names, "name",
                              ["complete_time", "gs_handle"])
    inside = F.col("point.name") <= F.concat("name", F.lit("Z"))
    return found.select(F.col("name").alias("prefix"), *[
        F.when(inside, F.col(f"point.{c}")).alias(c) for c in names.columns])


def ready(found: DataFrame) -> DataFrame:
    """The backup is ready once it has a handle. Applied after the limit of `find_backup`, so an
    unfinished first match does not let a later one through."""
    return found.where(F.col("gs_handle").isNotNull())


def kind_uris(backup_info: DataFrame, kinds: list[str], timestamp_ms: int | None) -> DataFrame:
    """File URI and target table of every kind of every ready backup."""
    kind = F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind")
    suffix = "" if timestamp_ms is None else str(timestamp_ms)
    return (ready(backup_info).select("name", "gs_handle", kind)
            .select("name", "kind", keys.kind_uri(F.col("gs_handle"), F.col("kind")).alias("uri"),
                    F.concat("kind", F.lit(suffix)).alias("table_name")))


def read_kind(spark: SparkSession, handle: str, kind: str, fmt: str = "parquet",
              **options: str) -> DataFrame:
    """The rows of one kind. For CSV, `multiLine=True` admits quoted newlines."""
    return spark.read.format(fmt).options(**options).load(keys.kind_uri_text(handle, kind))
