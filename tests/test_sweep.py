"""The first point at or after many starts."""

import random

import pytest

from logtables.operators import sweep
from logtables.sources import backups

INFO = "name string, complete_time bigint, gs_handle string"


@pytest.mark.parametrize("partitions", ["1", "5", "64"])
def test_equal_to_each_start_alone(spark, partitions):
    """Starts between, on, before and after points; hot points and starts; nulls; empty ranges."""
    rng = random.Random(int(partitions))
    points = [(rng.randrange(300), rng.choice([None, rng.randrange(5)]), f"p{i}")
              for i in range(200)] + [(150, 1, "hot")] * 100 + [(None, 1, "none")]
    starts = [(rng.randrange(-20, 330),) for _ in range(150)] + [(150,)] * 50 + [(None,)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = sweep.next_points(
            spark.createDataFrame(starts, "k bigint"),
            spark.createDataFrame(points, "k bigint, t bigint, name string"), "k", ["t", "name"])
        got = {r.k: tuple(r.point) if r.point else None for r in found.collect()}
        assert found.count() == len(got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    def order(p):
        return (p[0], p[1] is not None, p[1] or 0, p[2])

    assert got == {s: min((p for p in points if p[0] is not None and p[0] >= s), key=order,
                          default=None) for s, in starts if s is not None}


def test_nothing(spark):
    starts, points = spark.createDataFrame([(5,)], "k int"), spark.createDataFrame([], "k int")
    assert [tuple(r) for r in sweep.next_points(starts, points, "k").collect()] == [(5, None)]
    assert sweep.next_points(points, starts, "k").count() == 0


def test_overlapping_prefixes(spark):
    """Every prefix alone gives the same; a prefix within another, equal to a name, repeated, without a
    name, with names above the range only."""
    rows = [("a1_2", 5, "h"), ("a1_x", 1, "h"), ("a10", None, None), ("a10", 3, "g"), ("a1", 1, None),
            ("b1_a", 1, "h"), ("b1_Zz", 1, "h"), ("b1_Z", 2, "z"), ("ac", 1, "h")]
    info = spark.createDataFrame(rows, INFO)
    prefixes = ["a", "a1", "a1_", "a10", "b1_", "b", "a1", "c", "", "a1_x", "b1_Zz", "aZ"]
    found = backups.find_backups(info, spark.createDataFrame([(p,) for p in prefixes],
                                                             "prefix string"))
    got = {r.prefix: (r.name, r.complete_time, r.gs_handle) for r in found.collect()}
    expected = {}
    for p in prefixes:
        one = info.where((info.name >= p) & (info.name <= p + "Z")).orderBy(
            "name", "complete_time", "gs_handle").limit(1).collect()
        expected[p] = tuple(one[0]) if one else (None, None, None)
    assert got == expected and found.count() == len(set(prefixes))
    assert expected["a1_"][0] == "a1_2" and expected["c"][0] is None


def test_the_sweep_pairs_nothing(spark):
    starts, points = (spark.range(50).withColumnRenamed("id", "k") for _ in range(2))
    plan = sweep.next_points(starts, points, "k")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
