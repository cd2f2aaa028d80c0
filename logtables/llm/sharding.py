"""Shards by jump consistent hashing: no ring table, and growth moves only what it must."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtables.llm.shared import kept, ranked, text_bytes

#: The multiplier of the published 64-bit linear congruential generator. A fixed value.
STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key: jump from one candidate to the next until past the last shard.

    Going from n to n + 1 shards, a key either stays or goes to the new one, which it does with
    probability 1 / (n + 1).
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    landing = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while active.size:
        shard[active] = landing[active]
        with np.errstate(over="ignore"):
            state[active] = state[active] * STEP + np.uint64(1)
        draw = (state[active] >> np.uint64(33)).astype(np.float64) + 1
        landing[active] = ((shard[active] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        active = active[landing[active] < shards]
    return shard.astype(np.int32)


def shard_of(key: str | Column, shards: int) -> Column:
    """The shard (int) of a bigint key. A null key counts as 0."""

    @F.pandas_udf("int")
    def jumped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy(np.int64), shards))

    return jumped(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(0)).cast("bigint"))


def assign_shards(docs: DataFrame, shards: int = 8, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """Each document's shard, its place in the shard, and its shard once one more is appended.

    Columns: the key, size, text_crc32, law, shard, slot, grown_shard. The key and the number of
    shards alone decide, so equal keys share a shard. Slots follow the key, gapless from 0; rows
    with equal keys take consecutive slots in any order. Null key: as 0. Null text: size 1, the CRC
    of no bytes. No rows in, none out; other columns are not read.
    """
    narrow = docs.select(
        F.col(key), (text_bytes(F.col(text)) + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = narrow.select(
        "*", F.lit("key").alias("law"), shard_of(key, shards).alias("shard"),
        shard_of(key, shards + 1).alias("grown_shard"))
    return ranked(kept(placed), "shard", [key], "slot").select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
