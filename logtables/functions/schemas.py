"""Schema functions over field lists held as data: `array<struct<name, type, …>>` in field order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_hash(fields: Column) -> Column:
    """First six hex digits of the MD5 over name and type of every field, types as declared."""
    text = F.array_join(F.transform(fields, lambda f: F.concat(f["name"], f["type"])), "")
    return F.substring(F.md5(text.cast("binary")), 1, 6)


def mode(repeated: Column) -> Column:
    return F.when(repeated, F.lit("REPEATED")).otherwise(F.lit("NULLABLE"))


def duplicate_fields(field_sets: DataFrame) -> DataFrame:
    """Names a set uses more than once. Sets without any are dropped row by row, ahead of the
    shuffle."""
    suspects = field_sets.where(F.size(F.array_distinct("fields.name")) < F.size("fields"))
    return (suspects.select("set_name", F.explode("fields.name").alias("name"))
            .groupBy("set_name", "name").agg(F.count("*").alias("uses"))
            .where(F.col("uses") > 1))


def table_fields(field_sets: DataFrame) -> DataFrame:
    """The stored schema of every set: types in lower case, no trace of required fields."""
    return field_sets.select("set_name", F.inline("fields")).select(
        "set_name", "ord", "name", F.lower("type").alias("type"), mode(F.col("repeated")).alias("mode"))
