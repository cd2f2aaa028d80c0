"""What runs inside the tasks of `batching`: NumPy over the rows of one slice."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# Ship this module with its functions, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes counted for the first batch of a group before any row. Later batches start at 0.
FIRST_BATCH_BYTES = 2


@dataclass(frozen=True)
class Transfer:
    """What a run of rows does to the open batch.

    With `carry` bytes on entry and `carry + total <= limit` nothing closes. Otherwise the first
    entry whose `upto` exceeds `limit - carry` tells the batches closed and the bytes open on exit.
    """

    total: int
    upto: np.ndarray
    closed: np.ndarray
    open_bytes: np.ndarray

    def apply(self, carry: int, limit: int) -> tuple[int, int]:
        if carry + self.total <= limit:
            return 0, carry + self.total
        i = int(np.searchsorted(self.upto, limit - carry, side="right"))
        return int(self.closed[i]), int(self.open_bytes[i])


def summarize(sizes: np.ndarray, limit: int) -> Transfer:
    """Transfer of a run of row sizes."""
    n = len(sizes)
    ends = np.cumsum(sizes, dtype=np.int64)
    begins = ends - sizes
    # Rows at which an entry carry of 0..limit, or above, can force the first cut.
    heads = min(int(np.searchsorted(ends, limit, side="right")) + 1, n)
    row = np.arange(heads)
    closed = np.ones(heads, dtype=np.int64)
    alive = np.arange(heads)
    while alive.size:
        following = np.searchsorted(ends, begins[row[alive]] + limit, side="right")
        following = np.maximum(following, row[alive] + 1)
        alive, following = alive[following < n], following[following < n]
        row[alive] = following
        closed[alive] += 1
    open_bytes = ends[-1] - begins[row] if n else np.zeros(0, dtype=np.int64)
    # Starts with the same outcome are neighbours; the last of each run stands for it.
    last = np.ones(heads, dtype=bool)
    last[:-1] = (closed[1:] != closed[:-1]) | (open_bytes[1:] != open_bytes[:-1])
    return Transfer(int(ends[-1]) if n else 0, ends[:heads][last], closed[last], open_bytes[last])


def number_rows(sizes: np.ndarray, carry: int, batch: int, limit: int) -> tuple[np.ndarray, int, int]:
    """Batch of every row of a run, and the state after it."""
    n = len(sizes)
    ends = np.cumsum(sizes, dtype=np.int64)
    cuts = np.zeros(n, dtype=np.int64)
    base = -carry
    row = int(np.searchsorted(ends, limit + base, side="right"))
    while row < n:
        cuts[row] = 1
        base = int(ends[row] - sizes[row])
        row = max(int(np.searchsorted(ends, base + limit, side="right")), row + 1)
    numbers = batch + np.cumsum(cuts)
    if n:
        carry, batch = int(ends[-1]) - base, int(numbers[-1])
    return numbers, carry, batch


def _runs(group: pa.Array) -> list[tuple[int, int]]:
    """Start and end of each run of equal group values in a batch."""
    codes = group.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(codes)]))


def compose(first: Transfer, then: Transfer, limit: int) -> Transfer:
    """What two runs do, one after the other.

    An entry that closes nothing in the first run may close its first batch in the second, at the
    rows `then` lists; one that does close leaves a known number of bytes open.
    """
    fits = first.open_bytes + then.total <= limit
    at = np.searchsorted(then.upto, limit - first.open_bytes, side="right")
    at = np.minimum(at, max(0, len(then.upto) - 1))
    more = np.where(fits, 0, then.closed[at]) if len(then.upto) else np.zeros(len(fits), np.int64)
    left = np.where(fits, first.open_bytes + then.total, then.open_bytes[at] if len(then.upto)
                    else 0)
    # The tables hold for entries above the limit too; later rows matter up to one limit only.
    later = first.total + then.upto
    return _thin(Transfer(first.total + then.total,
                          np.concatenate([first.upto, later]),
                          np.concatenate([first.closed + more, then.closed]),
                          np.concatenate([left, then.open_bytes])), limit)


def _thin(t: Transfer, limit: int) -> Transfer:
    """Without entries that no open batch can reach, and with one for each run of equal outcomes."""
    n = int(np.searchsorted(t.upto, limit, side="right")) + 1
    upto, closed, left = t.upto[:n], t.closed[:n], t.open_bytes[:n]
    last = np.ones(len(upto), dtype=bool)
    last[:-1] = (closed[1:] != closed[:-1]) | (left[1:] != left[:-1])
    return Transfer(t.total, upto[last], closed[last], left[last])


NOTHING = Transfer(0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def carried(data: pa.RecordBatch, at: int) -> tuple[int, int]:
    """Bytes open and the batch's number before the first row of the group that a row belongs to."""
    if "_carry_bytes" not in data.schema.names:
        return FIRST_BATCH_BYTES, 0
    return data.column("_carry_bytes")[at].as_py(), data.column("_carry_batch")[at].as_py()


def summarize_slice(limit: int):
    def rows_of(part, group, starts, transfer, carry) -> dict:
        return {"slice": part, "group": group, "starts": starts, "total": transfer.total,
                "upto": transfer.upto, "closed": transfer.closed,
                "open_bytes": transfer.open_bytes, "carry_bytes": carry[0],
                "carry_batch": carry[1]}

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The transfer of the group a slice begins in and, if another, of the one it ends in."""
        part, first, last, so_far, found, carry = None, None, None, NOTHING, [], None
        for data in batches:
            if not data.num_rows:
                continue
            part = data.column("_slice")[0].as_py()
            group = data.column("_group")
            values = data.column("_size").to_numpy(zero_copy_only=False)
            for start, end in _runs(group):
                name = group[start].as_py()
                if first is None:
                    first = last = name
                    carry = carried(data, start)
                if name != last:
                    if last == first:
                        found.append(rows_of(part, first, False, so_far, carry))
                    last, so_far, carry = name, NOTHING, carried(data, start)
                so_far = compose(so_far, summarize(values[start:end], limit), limit)
        if part is None:
            return
        found.append(rows_of(part, last, last != first, so_far, carry))
        yield pa.RecordBatch.from_pylist(found, schema=pa.schema([
            ("slice", pa.int32()), ("group", pa.string()), ("starts", pa.bool_()),
            ("total", pa.int64()), ("upto", pa.list_(pa.int64())),
            ("closed", pa.list_(pa.int64())), ("open_bytes", pa.list_(pa.int64())),
            ("carry_bytes", pa.int64()), ("carry_batch", pa.int64()),
        ]))
    return summary


def walk_slices(limit: int):
    """Carry the open batch along each group's slices. A slice in which the group starts has no
    entry: the group's first row goes on with what was open before, or opens its first batch."""
    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, open_bytes, batch = None, 0, 0
        for frame in frames:
            entries = []
            for row in frame.itertuples(index=False):
                if row.group != group:
                    group, open_bytes, batch = row.group, row.carry_bytes, row.carry_batch
                if not row.starts:
                    entries.append((row.slice, open_bytes, batch))
                closed, open_bytes = Transfer(
                    row.total, row.upto, row.closed, row.open_bytes).apply(open_bytes, limit)
                batch += closed
            yield pd.DataFrame(entries, columns=["slice", "entry_bytes", "entry_batch"])
    return walk


def number_slice(limit: int, columns: list[str]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_bytes, batch, started = None, 0, 0, False
        for data in batches:
            if not data.num_rows:
                continue
            group = data.column("_group")
            values = data.column("_size").to_numpy(zero_copy_only=False)
            numbers = np.empty(data.num_rows, dtype=np.int64)
            for start, end in _runs(group):
                name = group[start].as_py()
                if not started:
                    open_bytes = data.column("entry_bytes")[start].as_py()
                    batch = data.column("entry_batch")[start].as_py()
                    if open_bytes is None:
                        open_bytes, batch = carried(data, start)
                elif name != current:
                    open_bytes, batch = carried(data, start)
                current, started = name, True
                numbers[start:end], open_bytes, batch = number_rows(
                    values[start:end], open_bytes, batch, limit)
            yield pa.RecordBatch.from_arrays(
                [*[data.column(c) for c in columns], pa.array(numbers)], [*columns, "batch"])
    return number
