import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logtables.operators import batching, greedy


def walk(sizes, limit, carry=greedy.FIRST_BATCH_BYTES, batch=0):
    """The rule, row by row."""
    numbers = []
    for size in sizes:
        if carry + size > limit:
            carry, batch = 0, batch + 1
        carry += size
        numbers.append(batch)
    return numbers, carry, batch


SIZES = st.lists(st.integers(0, 40), max_size=60)


@settings(max_examples=300, deadline=None)
@given(SIZES, st.integers(1, 60), st.integers(0, 120))
def test_transfer_and_numbers_follow_the_rule(sizes, limit, carry):
    numbers, open_bytes, batch = walk(sizes, limit, carry)
    array = np.array(sizes, dtype=np.int64)
    if sizes:
        assert greedy.summarize(array, limit).apply(carry, limit) == (batch, open_bytes)
    found = greedy.number_rows(array, carry, 0, limit)
    assert found[0].tolist() == numbers and found[1:] == (open_bytes, batch)


@settings(max_examples=300, deadline=None)
@given(SIZES, st.lists(st.integers(0, 60), max_size=5), st.integers(1, 60), st.integers(0, 120))
def test_composed_transfers_follow_the_rule(sizes, cuts, limit, carry):
    array = np.array(sizes, dtype=np.int64)
    transfer = greedy.NOTHING
    for part in np.split(array, sorted(min(c, len(sizes)) for c in cuts)):
        if len(part):
            transfer = greedy.compose(transfer, greedy.summarize(part, limit), limit)
    if sizes:
        _, open_bytes, batch = walk(sizes, limit, carry)
        assert transfer.apply(carry, limit) == (batch, open_bytes)


def test_a_slice_is_never_held_whole():
    """Many batches of one group pass through; what is kept is bounded by the limit."""
    def batches():
        for i in range(300):
            yield pa.RecordBatch.from_pydict({
                "_group": ["g"] * 10_000, "_slice": pa.array([0] * 10_000, pa.int32()),
                "_size": np.full(10_000, 97 + i % 5)})

    tracemalloc.start()
    found = list(greedy.summarize_slice(50_000)(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0].num_rows == 1 and peak < 4_000_000  # all sizes would be 24 MB


def test_groups_a_microsecond_apart_are_two(spark):
    rows = spark.sql("SELECT timestamp_micros(id % 2) AS g, id AS o, 60L AS s FROM range(4)")
    found = batching.byte_batches(rows, ["g"], ["o"], "s", limit=100, slices=2)
    assert sorted((r.o, r.batch) for r in found.collect()) == [(0, 0), (1, 0), (2, 1), (3, 1)]


def brute_force(table, limit):
    expected = {}
    for group in {g for g, _, _ in table}:
        mine = sorted((o, s) for g, o, s in table if g == group)
        for (o, _), n in zip(mine, walk([s for _, s in mine], limit)[0]):
            expected[group, o] = n
    return expected


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_hot_group_over_many_slices(spark, slices):
    rng = random.Random(7)
    table = [("hot" if rng.random() < 0.7 else rng.choice("abcdefgh"), i, rng.randint(1, 300))
             for i in range(3000)]
    rows = spark.createDataFrame(table, "g string, o bigint, s bigint").repartition(5)
    found = batching.byte_batches(rows, ["g"], ["o"], "s", limit=1000, slices=slices)
    assert {(r.g, r.o): r.batch for r in found.collect()} == brute_force(table, 1000)


def test_equal_sizes_never_coincide(spark):
    """Chains from different starts do not meet: the largest summaries."""
    table = [("x", i, 7) for i in range(2000)]
    rows = spark.createDataFrame(table, "g string, o bigint, s bigint")
    found = batching.byte_batches(rows, ["g"], ["o"], "s", limit=100, slices=9)
    assert {(r.g, r.o): r.batch for r in found.collect()} == brute_force(table, 100)


def test_bounds(spark):
    # Reaching the limit exactly stays; a first row above it leaves batch 0 empty.
    table = [("exact", 1, 58), ("exact", 2, 40), ("exact", 3, 1),
             ("big", 1, 500), ("big", 2, 500), ("big", 3, 10),
             ("two", 1, 99)]
    rows = spark.createDataFrame(table, "g string, o bigint, s bigint")
    found = batching.byte_batches(rows, ["g"], ["o"], "s", limit=100, slices=2)
    assert sorted((r.g, r.o, r.batch) for r in found.collect()) == [
        ("big", 1, 1), ("big", 2, 2), ("big", 3, 3),
        ("exact", 1, 0), ("exact", 2, 0), ("exact", 3, 1), ("two", 1, 1)]
    sizes = batching.batch_sizes(found, ["g"], "s").where("g = 'exact'").orderBy("batch").collect()
    assert [(r.batch, r.row_count, r.total_bytes) for r in sizes] == [(0, 2, 98), (1, 1, 1)]


def test_null_and_compound_groups_and_empty_input(spark):
    table = [(None, 1, 1, 60), (None, 1, 2, 60), ("a", 1, 1, 60), ("a", 2, 1, 60)]
    rows = spark.createDataFrame(table, "g string, h int, o bigint, s bigint")
    found = batching.byte_batches(rows, ["g", "h"], ["o"], "s", limit=100, slices=3)
    assert sorted((r.g or "", r.h, r.o, r.batch) for r in found.collect()) == [
        ("", 1, 1, 0), ("", 1, 2, 1), ("a", 1, 1, 0), ("a", 2, 1, 0)]
    empty = batching.byte_batches(rows.limit(0), ["g"], ["o"], "s", limit=100, slices=3)
    assert empty.columns == ["g", "h", "o", "s", "batch"] and empty.count() == 0


def test_a_join_asks_for_no_more_slices_than_its_sides(spark, tmp_path):
    """The planner takes the product of both sides for a join's size: thousands of slices here."""
    rng = random.Random(3)
    noise = [(i, "".join(rng.choices("abcdefghijklmnop", k=400))) for i in range(2000)]
    for side in "lr":
        spark.createDataFrame(noise, f"{side} bigint, t{side} string").write.parquet(
            f"{tmp_path}/{side}")
    left, right = (spark.read.parquet(f"{tmp_path}/{side}") for side in "lr")
    joined = left.join(right, left.l == right.r, "left").select(
        "l", (F.octet_length("tl") + F.octet_length("tr")).cast("bigint").alias("s"))
    product = int(str(joined._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert product // batching.SLICE_BYTES > 100
    cores = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert batching.estimated_slices(joined) == cores
    # Of what an RDD holds nothing is known, whatever is selected from it.
    rdd = spark.createDataFrame(spark.sparkContext.parallelize(noise), "g bigint, t string")
    assert batching.estimated_slices(rdd.select("g")) == cores
    assert batching.estimated_slices(joined.localCheckpoint()) == cores


def test_a_table_has_slices_by_its_size(spark, tmp_path, monkeypatch):
    spark.range(100_000).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    monkeypatch.setattr(batching, "SLICE_BYTES", size // 100)
    assert batching.estimated_slices(table) in (100, 101)
    assert batching.estimated_slices(table.unionAll(table)) in (200, 201, 202)
