import numpy as np
import pytest
from pyspark.sql import functions as F

from logtables.llm import topk

NAN, INF = float("nan"), float("inf")


def brute(vectors, is_query, k):
    out = []
    for q in sorted(v for v in vectors if is_query(v)):
        found = sorted((-int(np.dot(vectors[q], vectors[c])), c) for c in vectors if c != q)
        out += [(q, n, c, -s) for n, (s, c) in enumerate(found[:k], 1)]
    return out


@pytest.mark.parametrize("n, width, k, spread", [(400, 16, 7, 40), (300, 5, 20, 2), (30, 3, 50, 9)])
def test_against_all_pairs(n, width, k, spread):
    rng = np.random.default_rng(n)
    x = rng.integers(-spread, spread + 1, (n, width)).astype(float)
    ids = np.arange(n) * 3
    q = x[::5]
    found = topk.search_block(q, ids, x, ids[::5], k)
    expected = brute(dict(zip(ids.tolist(), x)), lambda v: v // 3 % 5 == 0, k)
    got = [(int(ids[::5][i]), r, int(ids[c]), int(s))
           for i, rows, scores in found for r, (c, s) in enumerate(zip(rows, scores), 1)]
    assert got == expected


def test_reading_may_stop_early():
    """Far from all others, the best are found without reading the light lists to the end."""
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (2000, 32)).astype(float)
    x[:40] *= 30
    found = topk.search_block(x[:4], np.arange(2000), x, np.arange(4), 5)
    expected = brute(dict(enumerate(x)), lambda v: v < 4, 5)
    assert [(i, r, int(c), int(s)) for i, rows, scores in found
            for r, (c, s) in enumerate(zip(rows, scores), 1)] == expected


def test_blocks_and_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(0, 0.2, 6)], "x", 1) for i in range(120)]
    rows += [(200, None, "x", 1), (220, [0.1, None, 0.2, 0.0, 0.0, 0.1], "x", 1),
             (240, [NAN] * 6, "x", 1), (260, [INF, 0.0, 0.0, 0.0, 0.0, 0.0], "x", 1), (None, [0.1] * 6, "x", 1),
             (280, [0.5, 0.5], "x", 1), (300, [], "x", 1), rows[20], (20, [0.9] * 6, "x", 1)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank string, q int")
    found = topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=4, candidates=16, queries=3)
    known = []
    for vec_id, v, *_ in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = np.zeros(6)
        x[:len(v)] = np.floor(64 * np.float64(np.float32(v)))
        known.append((vec_id, x))
    expected = []
    for n, (q, x) in enumerate(known):
        if q % 20 == 0:
            others = sorted((-int(np.dot(x, y)), c) for m, (c, y) in enumerate(known) if m != n)
            expected += [(q, r, c, -s) for r, (s, c) in enumerate(others[:4], 1)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_large_values(spark):
    """Scores beyond 53 bits are exact, those beyond 64 and components beyond 32 saturate."""
    rows = [(0, [3e7, 1.0]), (1, [3e7, 2.0]), (2, [3e7, 1.0]), (3, [1e30, 1.0]), (4, [-3e7, 0.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"),
                       F.col("vec_id") == 0, k=4)
    big = 64 * 3 * 10**7
    assert [tuple(r) for r in found.orderBy("rank").collect()] == [
        (0, 1, 3, big * (2**31 - 1) + 64 * 64), (0, 2, 1, big**2 + 64 * 128),
        (0, 3, 2, big**2 + 64 * 64), (0, 4, 4, -big**2)]
