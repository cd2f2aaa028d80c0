"""Merging copies within a task, ahead of a shuffle: what runs inside the tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# Ship this module with its functions, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def least_copies(keys: list[str], by: str, drop: list[str]):
    """Of the rows of an Arrow batch that agree in `keys`, keep the one with the least `by`. Rows in which
    the first key is null are no copies. The columns in `drop` end here."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in batches:
            known = pd.DataFrame({k: data.column(k).to_pandas() for k in keys})
            order = known.assign(_by=data.column(by).to_pandas()).sort_values("_by", kind="stable")
            copies = order.duplicated(keys).sort_index().to_numpy() & known[keys[0]].notna().to_numpy()
            kept = data.filter(pa.array(~copies)) if copies.any() else data
            yield kept.drop_columns(drop) if drop else kept
    return combine


def first_copies(key: str, time: str):
    """Keep the first of the rows of an Arrow batch that agree in key and time."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in batches:
            pairs = pd.DataFrame({
                "key": data.column(key).to_pandas(),
                "time": data.column(time).cast(pa.int64()).to_pandas()})
            copies = pairs.duplicated().to_numpy()
            yield data.filter(pa.array(~copies)) if copies.any() else data
    return combine
