"""Row assembly: extract every field of a set, format it by type, check the required ones.

The field expressions are evaluated under positional names first; formatting, checks and sizes are
SQL text over those names, which Spark folds into the same projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.functions.rows import literal, row_bytes, text_length
from logtables.spec import FieldSet, FieldSpec, InvalidFieldError

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _evaluated(logs: DataFrame, field_set: FieldSet, keep: Sequence[Column | str]
               ) -> tuple[DataFrame, list[str], list[tuple[FieldSpec, str, T.DataType]]]:
    """The field expressions as `_field0`, `_field1`, …, with the kept columns ahead of them.

    The shared columns of an exporter are seen by its own fields only: where one hides a column of
    the input, that column is put aside and comes back before the next exporter.
    """
    given, wide, specs, names = logs.columns, logs, [], []
    for exporter in field_set.exporters:
        own = [f"_field{len(names) + i}" for i in range(len(exporter.fields))]
        specs += exporter.fields
        names += own
        shared = {n: F.expr(c) if isinstance(c, str) else c for n, c in exporter.shared.items()}
        hidden = {c: f"_hidden_{c}" for c in given if c.lower() in {n.lower() for n in shared}}
        if shared:
            wide = wide.withColumns({aside: F.col(c) for c, aside in hidden.items()})
            wide = wide.withColumns(shared)
        wide = wide.withColumns({n: s.column() for s, n in zip(exporter.fields, own)})
        if shared:
            wide = wide.drop(*[n for n in shared if n.lower() not in {c.lower() for c in hidden}])
            wide = wide.withColumns({c: F.col(aside) for c, aside in hidden.items()})
            wide = wide.drop(*hidden.values())
    wide = wide.select(*keep, *names)
    kept = [f"`{c}`" for c in wide.columns[:len(wide.columns) - len(names)]]
    schema = wide.schema
    return wide, kept, [(s, n, schema[n].dataType) for s, n in zip(specs, names)]


def _time_as_millis(value: str, spec: FieldSpec, dtype: T.DataType) -> str:
    """Dates in an integer field count as epoch milliseconds."""
    if spec.kind != "integer":
        return value
    if isinstance(dtype, TIME_TYPES):
        return f"unix_millis(cast({value} AS timestamp))"
    if spec.repeated and isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, TIME_TYPES):
        return f"transform({value}, v -> unix_millis(cast(v AS timestamp)))"
    return value


def _parts(value: str, spec: FieldSpec, dtype: T.DataType):
    """(name in the source, sub-field, its type) of a record's value; all must be there."""
    if not isinstance(dtype, T.StructType):
        raise InvalidFieldError(f"record {spec.name} needs a struct")
    by_name = {f.name.lower(): f for f in dtype.fields}
    for sub in spec.fields:
        if sub.name.lower() not in by_name:
            raise InvalidFieldError(f"record {spec.name} has no value for {sub.name}")
        found = by_name[sub.name.lower()]
        yield f"{value}.`{found.name}`", sub, found.dataType


def _single(spec: FieldSpec) -> FieldSpec:
    return replace(spec, repeated=False)


def _items(spec: FieldSpec, dtype: T.DataType) -> T.DataType:
    if not isinstance(dtype, T.ArrayType):
        raise InvalidFieldError(f"repeated field {spec.name} needs an array")
    return dtype.elementType


def _lossy(value: str, spec: FieldSpec, dtype: T.DataType) -> str | None:
    """Whether a value that does convert would become another one; None if it never does."""
    if spec.kind == "integer" and isinstance(dtype, T.FractionalType):
        return f"cast(try_cast({value} AS bigint) AS {dtype.simpleString()}) != {value}"
    if spec.kind == "float" and isinstance(dtype, T.LongType | T.DecimalType):
        return f"NOT (try_cast(cast({value} AS double) AS {dtype.simpleString()}) <=> {value})"
    if spec.kind == "boolean" and isinstance(dtype, T.NumericType):
        return f"{value} NOT IN (0, 1)"
    return None


def bad_value(value: str, spec: FieldSpec, dtype: T.DataType, depth: int = 0) -> str | None:
    """SQL that is true for a value which is not of the declared type, in whole or in a part of it:
    an item of an array, a sub-field of a record. None if no value can be."""
    if spec.repeated:
        item = f"v{depth}"
        inner = bad_value(item, _single(spec), _items(spec, dtype), depth + 1)
        return inner and f"coalesce(exists({value}, {item} -> {inner}), false)"
    if spec.kind == "record":
        found = [bad_value(*part, depth) for part in _parts(value, spec, dtype)]
        found = [f for f in found if f]
        return f"({' OR '.join(found)})" if found else None
    target = spec.data_type()
    if dtype == target or spec.kind == "string" or (
            spec.kind == "integer" and isinstance(dtype, TIME_TYPES)):
        return None
    tests = [f"try_cast({value} AS {target.simpleString()}) IS NULL"]
    if lossy := _lossy(value, spec, dtype):
        tests.append(f"coalesce({lossy}, true)")
    return f"({value} IS NOT NULL AND ({' OR '.join(tests)}))"


def format_value(value: str, spec: FieldSpec, dtype: T.DataType, lenient: bool = False,
                 depth: int = 0) -> str:
    """Bring a value to its declared type, records by the names of their sub-fields.

    Lenient turns values that do not convert into null; `bad_value` tells them. Otherwise they fail
    the job, those that would lose something too.
    """
    if spec.repeated:
        item = f"v{depth}"
        element = _items(spec, dtype)
        inner = format_value(item, _single(spec), element, lenient, depth + 1)
        return value if inner == item else f"transform({value}, {item} -> {inner})"
    if spec.kind == "record":
        parts = ", ".join(f"{literal(sub.name)}, {format_value(v, sub, t, lenient, depth)}"
                          for v, sub, t in _parts(value, spec, dtype))
        if dtype == spec.data_type(null_items=True):
            return value
        return f"if({value} IS NULL, NULL, named_struct({parts}))"
    if spec.kind == "integer" and isinstance(dtype, TIME_TYPES):
        return f"unix_millis(cast({value} AS timestamp))"
    target = spec.data_type()
    if dtype == target:
        return value
    if lenient:
        return f"try_cast({value} AS {target.simpleString()})"
    plain = f"cast({value} AS {target.simpleString()})"
    lossy = _lossy(value, spec, dtype)
    message = literal(f"a value of {spec.name} would be altered as {spec.kind}")
    return f"if({lossy}, raise_error({message}), {plain})" if lossy else plain


def required(value: str, spec: FieldSpec) -> str:
    """Abort the job on a null in a required field.

    The check sits inside the column: as a column of its own, Catalyst would prune it.
    """
    if spec.nullable:
        return value
    return f"coalesce({value}, raise_error({literal(f'no value for required field {spec.name}')}))"


def export_rows(logs: DataFrame, field_set: FieldSet, keep: Sequence[Column | str] = (),
                check_required: bool = True) -> DataFrame:
    """One projection with every field of the set, after the columns in `keep`."""
    wide, kept, fields = _evaluated(logs, field_set, keep)
    columns = []
    for spec, name, dtype in fields:
        value = format_value(name, spec, dtype)
        columns.append(f"{required(value, spec) if check_required else value} AS `{spec.name}`")
    return wide.selectExpr(*kept, *columns)


def row_size(rows: DataFrame, field_set: FieldSet) -> Column:
    """Byte size of assembled rows."""
    schema = rows.schema
    return F.expr(row_bytes([(n, f"`{n}`", schema[n].dataType) for n in field_set.names]))


BAD_TYPE = "bad_type"
OVERSIZE = "oversize"
#: The wording of an over-size reject.
OVERSIZE_MESSAGE = "Maximum allowed row size exceeded"


def _error(condition: str, reason: str, message: str) -> str:
    return (f"if({condition}, array(named_struct('reason', {literal(reason)}, "
            f"'message', {literal(message)})), array())")


def _checked_fields(checked: DataFrame, field_set: FieldSet):
    schema = checked.schema
    return [(s, f"_field{i}", schema[f"_field{i}"].dataType)
            for i, s in enumerate(field_set.fields)]


def checked_rows(logs: DataFrame, field_set: FieldSet, max_row_bytes: int | None,
                 keep: Sequence[Column | str] = ()) -> DataFrame:
    """Field values before formatting, with `row_bytes` and one row per failed rule.

    A good row appears once, its `reason` and `message` null; `valid_rows` and `reject_rows` take
    the two kinds apart. A null in a required field still aborts: that is a contract of the
    exporter, not a property of the row.

    The errors are expanded before the split because a filter on the expanded columns stays above
    the projection. A filter on the list would be pushed below it as a predicate over every field,
    and Spark's constraint inference grows exponentially in the renamed columns of such a predicate.
    """
    wide, kept, fields = _evaluated(logs, field_set, keep)
    wide = wide.selectExpr(*kept, *[
        f"{required(_time_as_millis(n, s, t), s)} AS {n}" for s, n, t in fields])
    fields = _checked_fields(wide, field_set)
    sized = wide.selectExpr("*", row_bytes([(s.name, n, t) for s, n, t in fields]) + " AS row_bytes")
    errors = []
    for spec, name, dtype in fields:
        if bad := bad_value(name, spec, dtype):
            errors.append(_error(bad, BAD_TYPE,
                                 f"Value of {spec.name} is not of type {spec.kind}"))
    if max_row_bytes is not None:
        errors.append(_error(f"row_bytes > {max_row_bytes}", OVERSIZE, OVERSIZE_MESSAGE))
    # Joined lists stay in generated code; a higher-order filter over one list would not.
    found = f"concat({', '.join(errors)})" if errors else "array()"
    listed = sized.selectExpr(
        "*", f"cast({found} AS array<struct<reason:string,message:string>>) AS _errors")
    return listed.selectExpr("*", "inline_outer(_errors)").drop("_errors")


def valid_rows(checked: DataFrame, field_set: FieldSet, keep: Sequence[str] = ()) -> DataFrame:
    """The rows without errors, every field in its declared type."""
    return checked.where(F.col("reason").isNull()).selectExpr(*keep, *[
        f"{format_value(n, s, t, lenient=True)} AS `{s.name}`"
        for s, n, t in _checked_fields(checked, field_set)])


def reject_rows(checked: DataFrame, field_set: FieldSet, request_id: str = "requestId",
                keep: Sequence[str] = ()) -> DataFrame:
    """One row per error. Rows over the size limit carry the character length of every field."""
    fields = _checked_fields(checked, field_set)
    columns = {s.name: n for s, n, _ in fields}
    lengths = ", ".join(f"{literal(s.name)}, {text_length(n, t)}" for s, n, t in fields)
    return checked.where(F.col("reason").isNotNull()).selectExpr(
        *keep, f"{columns[request_id]} AS request_id",
        f"{columns.get('path', 'cast(NULL AS string)')} AS path", "row_bytes", "reason", "message",
        f"if(reason = {literal(OVERSIZE)}, map({lengths}), NULL) AS field_lengths")


REJECTED = ["request_id", "path", "row_bytes", "reason", "message", "field_lengths"]
ROWS, REJECTS = "rows", "rejects"


def outcome_rows(checked: DataFrame, field_set: FieldSet, request_id: str = "requestId",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Good rows and rejects from one pass, told apart by `outcome`.

    A good row has its fields and null in REJECTED; a reject the other way round.
    """
    fields = _checked_fields(checked, field_set)
    columns = {s.name: n for s, n, _ in fields}
    lengths = ", ".join(f"{literal(s.name)}, {text_length(n, t)}" for s, n, t in fields)
    good = "reason IS NULL"
    reject = [(columns.get(request_id, "cast(NULL AS string)"), "request_id"),
              (columns.get("path", "cast(NULL AS string)"), "path"),
              ("row_bytes", "row_bytes"), ("reason", "reason"), ("message", "message")]
    return checked.selectExpr(
        *keep, f"if({good}, '{ROWS}', '{REJECTS}') AS outcome",
        *[f"if({good}, {format_value(n, s, t, lenient=True)}, NULL) AS `{s.name}`"
          for s, n, t in fields],
        *[f"if({good}, NULL, {v}) AS _{name}" for v, name in reject],
        f"if(reason = {literal(OVERSIZE)}, map({lengths}), NULL) AS _field_lengths")
