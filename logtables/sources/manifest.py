"""Listings of stored log objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.functions import keys


def keys_between(manifest: DataFrame, start_key: str, end_key: str) -> DataFrame:
    """Keys strictly between the marker and the end key, as plain string ranges that push down."""
    return manifest.where((F.col("key") > start_key) & (F.col("key") < end_key))


def data_or_schema(manifest: DataFrame, read_schemas: bool) -> DataFrame:
    is_schema = F.col("key").endswith(keys.SCHEMA_SUFFIX)
    return manifest.where(is_schema if read_schemas else ~is_schema)


def log_uris(manifest: DataFrame, bucket: str, schema_hash: str, start_ms: int, end_ms: int,
             read_schemas: bool = False) -> DataFrame:
    """URIs of the objects of one schema that start in `[start_ms, end_ms)`."""
    found = keys_between(manifest, keys.log_key_text(schema_hash, start_ms, start_ms),
                         keys.log_key_text(schema_hash, end_ms, end_ms))
    found = data_or_schema(found, read_schemas)
    key = keys.strip_schema_suffix(F.col("key")) if read_schemas else F.col("key")
    return found.select("key", keys.object_uri(bucket, key).alias("uri"))
