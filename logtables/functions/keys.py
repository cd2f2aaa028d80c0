"""Object keys, backup names and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtables.spec import DEFAULT_BACKUP_PREFIX

SCHEMA_SUFFIX = ".schema"


def log_key(schema_hash: Column, start_ms: Column, end_ms: Column) -> Column:
    return F.format_string("log_%s_%020d_%020d", schema_hash, start_ms, end_ms)


def schema_key(schema_hash: Column, start_ms: Column, end_ms: Column) -> Column:
    return F.concat(log_key(schema_hash, start_ms, end_ms), F.lit(SCHEMA_SUFFIX))


def log_key_text(schema_hash: str, start_ms: int, end_ms: int) -> str:
    """The same key for a literal range bound."""
    return f"log_{schema_hash}_{start_ms:020d}_{end_ms:020d}"


def key_end_ms(key: Column) -> Column:
    """Last non-empty `_` part as a number; a key without one is an error."""
    trimmed = F.regexp_replace(key, "_+$", "")
    return F.substring_index(trimmed, "_", -1).cast("bigint")


def strip_schema_suffix(key: Column) -> Column:
    return F.regexp_replace(key, r"\.schema$", "")


def object_uri(bucket: str, key: Column) -> Column:
    return F.concat(F.lit(f"gs://{bucket}/"), key)


def backup_name(timestamp_ms: int, prefix: str | None) -> str:
    """Start of a backup's name; the backup itself appends its date."""
    return f"{DEFAULT_BACKUP_PREFIX if prefix is None else prefix}{timestamp_ms}_"


def kind_uri(handle: Column, kind: Column) -> Column:
    """Where one kind of a backup lies. Both replacements are literal and apply everywhere."""
    uri = F.replace(handle, F.lit("/gs/"), F.lit("gs://"))
    return F.replace(uri, F.lit("backup_info"), F.concat(kind, F.lit(".backup_info")))


def kind_uri_text(handle: str, kind: str) -> str:
    return handle.replace("/gs/", "gs://").replace("backup_info", f"{kind}.backup_info")


def kind_table(kind: str, timestamp_ms: int | None) -> str:
    return kind if timestamp_ms is None else f"{kind}{timestamp_ms}"
