"""Declarations: fields, exporters, field sets and export configurations."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.functions import times

# Declared type -> Spark type. Fixed values.
SCALAR_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
}

# Limits and cadences of an export. Fixed values.
MAX_BATCH_BYTES = 1_000_000
WINDOWS_PER_TRIGGER = 60
RUN_DELAY_MS = 60_000
DEFAULT_BACKUP_PREFIX = "snapshot"


class InvalidFieldError(ValueError):
    """A field set cannot become a table schema."""


@dataclass(frozen=True)
class FieldSpec:
    """One output column. `expr` is a Column or a SQL expression over the input row."""

    name: str
    type: str
    expr: Column | str | None = None
    nullable: bool = False
    repeated: bool = False
    fields: tuple[FieldSpec, ...] = ()

    @property
    def kind(self) -> str:
        return self.type.lower()

    @property
    def mode(self) -> str:
        return "REPEATED" if self.repeated else "NULLABLE"

    def column(self) -> Column:
        source = self.name if self.expr is None else self.expr
        return F.expr(source) if isinstance(source, str) else source

    def data_type(self, null_items: bool = False) -> T.DataType:
        """Spark type; `null_items` gives the form a cast accepts from any array."""
        if self.kind == "record":
            single = T.StructType(
                [T.StructField(f.name, f.data_type(null_items)) for f in self.fields])
        elif self.kind in SCALAR_TYPES:
            single = SCALAR_TYPES[self.kind]
        else:
            raise InvalidFieldError(f"field {self.name} has unknown type {self.type}")
        return T.ArrayType(single, null_items) if self.repeated else single


@dataclass(frozen=True)
class Exporter:
    """A named group of fields.

    `shared` holds columns computed once per record that the fields of this exporter, and no others,
    may refer to, for instance a struct from a vectorised UDF that several fields read.
    """

    name: str
    fields: tuple[FieldSpec, ...]
    shared: dict[str, Column | str] = field(default_factory=dict)


@dataclass(frozen=True)
class FieldSet:
    """Exporters in output order, a skip predicate and a version list."""

    exporters: tuple[Exporter, ...]
    skip: Column | str | None = None
    versions: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        seen = set()
        for spec in self.fields:
            spec.data_type()
            # Spark resolves names ignoring case, so a name that differs only in case clashes too.
            if spec.name.lower() in seen:
                raise InvalidFieldError(f"field set defines {spec.name} more than once")
            seen.add(spec.name.lower())

    @property
    def fields(self) -> tuple[FieldSpec, ...]:
        return tuple(spec for exporter in self.exporters for spec in exporter.fields)

    @property
    def names(self) -> list[str]:
        return [spec.name for spec in self.fields]

    def schema(self) -> T.StructType:
        """Table schema. Required fields stay nullable here: they are checked per row at export."""
        return T.StructType([T.StructField(f.name, f.data_type(), True) for f in self.fields])

    def schema_hash(self) -> str:
        """Six hex digits over the names and the types as declared, in order."""
        text = "".join(f.name + f.type for f in self.fields)
        return hashlib.md5(text.encode()).hexdigest()[:6]


@dataclass(frozen=True)
class LogExportConfig:
    """What one log export does. `table_id` and `next_table_id` map a window start (ms) to a table."""

    name: str
    field_set: FieldSet
    window_ms: int = 60_000
    table_id: Callable[[Column], Column] = times.month_id
    next_table_id: Callable[[Column], Column] = times.next_month_id
    min_level: int | None = None
    # Used when the field set lists no versions; None exports all of them.
    running_version: tuple[str, str] | None = None
    # Rows above this size, or with values that do not parse, are set aside instead of written.
    max_row_bytes: int | None = None

    def __post_init__(self):
        # The name is part of folder and table names.
        if not re.fullmatch(r"[A-Za-z0-9_-]+", self.name) or self.window_ms <= 0:
            raise ValueError("a log export needs a plain name and a positive window length")

    def versions(self) -> Sequence[tuple[str, str]]:
        if self.field_set.versions:
            return self.field_set.versions
        return [self.running_version] if self.running_version else []


@dataclass(frozen=True)
class SnapshotConfig:
    """What one snapshot export does."""

    kinds: tuple[str, ...]
    root: str
    database: str = "default"
    append_timestamp: bool = False
    skip_load: bool = False
    name_prefix: str | None = None
    # How long a folder stays after a load has replaced it.
    keep_replaced_ms: int = 3_600_000

    def __post_init__(self):
        if not self.kinds or not self.root:
            raise ValueError("a snapshot export needs kinds and a root folder")
        if not self.skip_load and not self.database:
            raise ValueError("a snapshot load needs a database")
