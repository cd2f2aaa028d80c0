"""Exact top-k inner products from sorted lists with lower and upper bounds.

Each dimension of a block of candidates is a list sorted by value. A query reads its lists in
rounds, heavy ones (large weights) further than light ones, and keeps for every candidate a lower and an
upper bound of its score: what has been read, and for the rest the best or worst value still to come.
It stops when few candidates have an upper bound that reaches the k-th best lower bound, and
works out the scores of those that do.

A block's lists are read as a whole matrix, weights not yet read set to zero, so a round costs as much
as scoring the block, and the last scores are looked up by candidate. This is dense scoring with bounds,
not a sequential read that saves work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtables.llm.shared import kept

#: Vectors to a block of candidates, queries to a block of queries. A task holds one of each.
CANDIDATES, QUERIES = 8192, 1024
#: Shares of the lists (heaviest first) read to the end by round; others are read to DEPTH.
ROUNDS = (0.5, 0.7, 0.85)
DEPTH = 0.125
#: The largest component, and the largest score that is shown.
LARGEST, LONGEST = (1 << 31) - 1, (1 << 63) - 1
FOUND = "query_id bigint, query bigint, vec_id bigint, row bigint, score bigint"


def quantized(vectors: DataFrame, scale: float = 64.0, key: str = "vec_id",
              vector: str = "embedding") -> DataFrame:
    """(vec_id, vec): floor(scale * x) of all components as packed int32; those beyond count as the
    nearest one that is not.

    Vectors that are null or hold null or non-finite components are left out, and null keys.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, keys, out = batch.column(1), batch.column(0), []
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            offsets = lists.offsets.to_numpy()
            good = np.isfinite(values)  # a null has become NaN
            bad = np.concatenate([[0], np.cumsum(~good)])
            whole = bad[offsets[1:]] == bad[offsets[:-1]]
            use = whole & lists.is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore"):
                ints = np.floor(scale * values)
            for i in np.flatnonzero(use):
                part = np.clip(ints[offsets[i]:offsets[i + 1]], -LARGEST, LARGEST)
                out.append(part.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [keys.filter(pa.array(use)), pa.array(out, pa.binary())], ["vec_id", "vec"])

    wide = vectors.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>"))
    return wide.mapInArrow(pack, "vec_id bigint, vec binary")


def matrix(vecs: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(vecs), width))
    for row, vec in zip(out, vecs, strict=True):
        part = np.frombuffer(vec, "<i4")
        row[:len(part)] = part
    return out


def search_wide(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: np.ndarray, k: int
                ) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """`search_block` where floating numbers would not be exact: Python integers, all candidates. A
    score beyond a long is shown, and compared, as the nearest one."""
    whole, out = vectors.astype(np.int64).astype(object), []
    for i, query in enumerate(queries):
        rows = np.flatnonzero(ids != own[i])
        scores = np.array([min(max(int(s), -LONGEST - 1), LONGEST) for s in
                           whole[rows] @ query.astype(np.int64).astype(object)], np.int64)
        top = np.argsort(~scores, kind="stable")[:k]
        out.append((i, rows[top], scores[top]))
    return out


def search_block(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: np.ndarray, k: int
                 ) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (row) the rows of its k best candidates, and their exact scores.

    `own` is the id each query must not return; ids are ascending, so equal scores keep their order.
    """
    n, width = vectors.shape
    most = np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0) * max(1, width)
    if most >= 2.0**53:
        return search_wide(queries, ids, vectors, own, k)
    kind = np.float32 if most < 2**23 else np.float64
    x, q = vectors.astype(kind), queries.astype(kind)
    # The sorted lists: best first for positive weights, so worst first for negative ones.
    ranks = np.argsort(vectors, axis=0, kind="stable")
    depth = max(k + 1, int(n * DEPTH))
    place = np.empty_like(ranks)
    np.put_along_axis(place, ranks, np.arange(n)[:, None], axis=0)
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    if depth < n:
        top_edge = np.take_along_axis(vectors, ranks[n - 1 - depth][None], 0)[0]
        low_edge = np.take_along_axis(vectors, ranks[depth][None], 0)[0]
    else:
        top_edge, low_edge = low, high
    from_top, from_low = place >= n - depth, place < depth
    # What a weight of either sign has read to DEPTH, or what bounds it.
    best = [np.where(from_top, vectors, top_edge).astype(kind),
            np.where(from_low, vectors, low_edge).astype(kind)]
    worst = [np.where(from_top, vectors, low).astype(kind),
             np.where(from_low, vectors, high).astype(kind)]
    heavy = np.argsort(-np.abs(q), axis=1, kind="stable")
    order = np.empty_like(heavy)
    np.put_along_axis(order, heavy, np.arange(width)[None], axis=1)
    mine = np.searchsorted(ids, own)
    mine = np.where((mine < n) & (ids[np.minimum(mine, n - 1)] == own), mine, -1)
    out: list = [None] * len(q)
    active = np.arange(len(q))
    for share in (*ROUNDS, 1.0):
        read = order[active] < int(np.ceil(width * share))
        full = np.where(read, q[active], 0)
        rest = q[active] - full
        up, down = np.maximum(rest, 0), np.minimum(rest, 0)
        sure = full @ x.T
        lower = sure + up @ worst[0].T + down @ worst[1].T
        upper = sure + up @ best[0].T + down @ best[1].T
        has = np.flatnonzero(mine[active] >= 0)
        lower[has, mine[active][has]] = -np.inf
        upper[has, mine[active][has]] = -np.inf
        if n > k:
            bar = np.partition(lower, n - k, axis=1)[:, n - k]
        else:
            bar = np.full(len(active), -np.inf)
        able = (upper >= bar[:, None]) & np.isfinite(upper)
        few = able.sum(axis=1) <= max(4 * k, n // 32)
        done = few if share < 1 else np.ones(len(active), bool)
        for r in np.flatnonzero(done):
            rows = np.flatnonzero(able[r])
            scores = (x[rows] @ q[active[r]]).astype(np.int64)
            top = np.argsort(-scores, kind="stable")[:k]
            out[active[r]] = (int(active[r]), rows[top], scores[top])
        active = active[~done]
        if not len(active):
            break
    return out


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, key: str = "vec_id",
          vector: str = "embedding", candidates: int = CANDIDATES, queries: int = QUERIES
          ) -> DataFrame:
    """The k best other vectors for each query: (query_id, rank, vec_id, score).

    `is_query` tells by a condition on `vec_id` which vectors are queries. Scores are integer inner
    products of quantized vectors; equal ones go by the smaller id. Vectors that are null or hold
    null or non-finite components take no part, nor do null ids. Rows that share an id stay apart:
    each is a query and a candidate of its own, and meets the others. Missing components of shorter
    vectors are zero; components beyond 32 bits and scores beyond 64 count as the nearest within.
    Fewer candidates than k: all. Empty table: no rows. Only the two columns are read.

    Blocks of vectors and of queries have a bounded size and are packed into one row each; every
    pair of blocks is a task's work and gives at most k rows per query. Blocks go by a hash of the
    id, so equal or similar vectors spread.
    """
    # Written with the rows' numbers, which tell a query from other rows of its id.
    packed = kept(quantized(vectors, scale, key, vector).withColumn(
        "row", F.monotonically_increasing_id()))
    total = packed.agg(F.count("*"), F.count(F.when(is_query, 1)),
                       F.max(F.octet_length("vec"))).first()
    width = (total[2] or 0) // 4
    c_blocks, q_blocks = max(1, -(-total[0] // candidates)), max(1, -(-total[1] // queries))

    def blocks(rows: DataFrame, number: int, name: str) -> DataFrame:
        by = F.pmod(F.xxhash64("row"), F.lit(number)).cast("int").alias(name)
        return rows.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("vec_id", "row", "vec")))
                                    .alias("rows"))

    def every(number: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias(name)

    left = blocks(packed.where(is_query), q_blocks, "q").select("q", "rows", every(c_blocks, "c"))
    right = blocks(packed, c_blocks, "c").select("c", "rows", every(q_blocks, "q"))

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")}, dtype="int64")
        asked, given = a["rows"].iloc[0], b["rows"].iloc[0]
        of, query = (np.array([r[c] for r in asked], np.int64) for c in ("vec_id", "row"))
        ids, row = (np.array([r[c] for r in given], np.int64) for c in ("vec_id", "row"))
        # In this order ids ascend; a query that is here too is known by its place.
        place = {r: i for i, r in enumerate(row.tolist())}
        own = np.array([place.get(r, -1) for r in query.tolist()], np.int64)
        found = search_block(matrix([r["vec"] for r in asked], width), np.arange(len(ids)),
                             matrix([r["vec"] for r in given], width), own, k)
        counts, at = [len(rows) for _, rows, _ in found], np.concatenate([r for _, r, _ in found])
        return pd.DataFrame({
            "query_id": np.repeat(of, counts), "query": np.repeat(query, counts),
            "vec_id": ids[at], "row": row[at],
            "score": np.concatenate([scores for _, _, scores in found])})

    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInPandas(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(
        F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
