import zlib
from collections import Counter

import numpy as np
import pytest

from logtables.llm import sharding

from .cases import edge_rows, edges, nothing


def published(key, shards):
    """The algorithm as published, one key at a time."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000])
def test_shards_are_those_of_the_published_algorithm(shards):
    keys = np.array([0, 1, -1, 7, 10**12, -(1 << 63), (1 << 63) - 1, *range(2000)], np.int64)
    assert sharding.jump_hash(keys, shards).tolist() == [published(int(k), shards) for k in keys]


def test_growth_moves_only_into_the_new_shard():
    keys = np.arange(20_000)
    before = sharding.jump_hash(keys, 8)
    for n in range(8, 16):
        after = sharding.jump_hash(keys, n + 1)
        moved = before != after
        assert (after[moved] == n).all() and abs(moved.mean() - 1 / (n + 1)) < 0.02
        before = after
    assert max(Counter(before.tolist()).values()) < 1.2 * len(keys) / 16


def test_at_least_one_shard():
    with pytest.raises(ValueError):
        sharding.jump_hash(np.arange(3), 0)


def test_edges(spark):
    found = sharding.assign_shards(edges(spark)).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in found), key=repr) == sorted((
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        for d, t, *_ in edge_rows()), key=repr)
    for r in found:
        assert r.law == "key" and r.shard == published(r.doc_id or 0, 8)
        assert r.grown_shard == published(r.doc_id or 0, 9)
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sharding.assign_shards(nothing(spark)).count() == 0
