"""Text forms and sizes of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_quote(value: Column) -> Column:
    """Double the quotes, turn CRLF and then LF into CR, wrap in quotes."""
    body = F.replace(value, F.lit('"'), F.lit('""'))
    body = F.replace(body, F.lit("\r\n"), F.lit("\r"))
    body = F.replace(body, F.lit("\n"), F.lit("\r"))
    return F.concat(F.lit('"'), body, F.lit('"'))


def csv_line(values: Sequence[Column]) -> Column:
    return F.concat_ws(",", *[csv_quote(v.cast("string")) for v in values])


# The functions below return SQL text over column names: a row's size is one wide expression, and
# parsing it once is cheaper than building it call by call.

def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def value_text(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """Text of a value inside a row: lists as `[a, b]`, records as `{k=v, k=v}`, null as `null`."""
    if isinstance(dtype, T.ArrayType):
        item = f"v{depth}"
        items = value_text(item, dtype.elementType, depth + 1)
        text = f"concat('[', array_join(transform({value}, {item} -> {items}), ', '), ']')"
    elif isinstance(dtype, T.StructType):
        parts = [f"{literal(f.name + '=')}, {value_text(f'{value}.`{f.name}`', f.dataType, depth)}"
                 for f in dtype.fields]
        text = f"if({value} IS NULL, NULL, concat('{{', {(", ', ', ").join(parts)}, '}}'))"
    else:
        text = f"cast({value} AS string)"
    return f"coalesce({text}, 'null')"


def row_bytes(columns: Sequence[tuple[str, str, T.DataType]]) -> str:
    """UTF-8 bytes of a row printed as `{k=v, k=v}`, plus one for the separator after it.

    Added up field by field, so the row text itself is never built; names, braces and separators
    are one constant.
    """
    names = sum(len(name.encode()) + 1 for name, _, _ in columns)
    fixed = 2 + names + 2 * max(len(columns) - 1, 0) + 1
    sizes = [f"octet_length({value_text(value, dtype)})" for _, value, dtype in columns]
    return " + ".join([f"{fixed}L", *sizes])


def text_length(value: str, dtype: T.DataType) -> str:
    """Characters of a value's text, null counting as 0."""
    return f"cast(if({value} IS NULL, 0, length({value_text(value, dtype)})) AS bigint)"
