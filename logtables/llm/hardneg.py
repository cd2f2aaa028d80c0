"""Hard negatives: exact inner products of anchors and candidates by Strassen's recursion over tiles,
kept in heaps that merge.

Rows are digitised to int64 and packed into blocks, anchors and candidates apart. A task multiplies
some anchor blocks by some candidate blocks, which it reads from the shared folder: no block is
copied for its tiles, neither to the driver nor through an exchange. Strassen's seven products
replace eight at each level, with additions and subtractions only, which are exact modulo 2**64:
sums on the way may wrap around, a result that fits does not. A tile adds to a bounded heap per
anchor what is as good as the heap's last entry; heaps merge in any order and in as many steps as
there are tiles. Positives come from a first pass. In a second one each positive's window is cut
out of the anchor's candidates in score order.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtables.llm.shared import folder, in_small_batches, kept, release

#: Rows of a block: one tile has ANCHORS x CANDIDATES scores of eight bytes.
ANCHORS, CANDIDATES = 1024, 4096
#: A pass has about TASKS tasks if it has as many tiles, and more where a task's candidate blocks would
#: have more bytes, at eight a component. Anchors have no more partitions than SPLITS.
TASKS, TASK_BYTES, SPLITS = 64, 1 << 26, 32
#: A side below this is multiplied directly.
LEAF = 32
#: Components beyond this size count as this, scores beyond a long as its limits.
HUGE = 1 << 62
LONGEST = (1 << 63) - 1
BLOCK = ("block bigint, height int, width int, bytes int, most double, row binary, label binary, "
         "vec_id binary, no_id binary, x binary")


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices (or of matrices of Python integers), exactly.

    Sides are padded with zeros to a multiple of 2 ** levels, each level halving all three of them,
    as long as the shortest is above `leaf`. Where no number on the way can leave the whole numbers
    that a float has exactly, the recursion takes floats, whose products are faster.
    """
    m, k, n = *a.shape, b.shape[1]
    if not (m and k and n):
        return np.zeros((m, n), a.dtype)
    levels = 0
    while min(m, k, n) >> levels > leaf:
        levels += 1
    sides = [-(-side >> levels) << levels if levels else side for side in (m, k, n)]
    # Each level doubles the factors at most and halves k; up to four products are added up.
    most = k * largest(a) * largest(b) << levels + 2
    kind = a.dtype if a.dtype == object else next(
        t for t, limit in ((np.float32, 2**24), (np.float64, 2**53), (a.dtype, most)) if most <= limit)
    padded = [np.zeros(shape, kind) for shape in ((sides[0], sides[1]), (sides[1], sides[2]))]
    padded[0][:m, :k], padded[1][:k, :n] = a, b
    return _strassen(*padded, levels)[:m, :n].astype(a.dtype)


def largest(a: np.ndarray) -> int:
    """The largest absolute value, as a Python integer."""
    return max(int(a.max()), -int(a.min()))


def _strassen(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.zeros((2 * m, 2 * n), a.dtype)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    product = _strassen(a11 + a22, b11 + b22, levels - 1)
    c11 += product
    c22 += product
    product = _strassen(a21 + a22, b11, levels - 1)
    c21 += product
    c22 -= product
    product = _strassen(a11, b12 - b22, levels - 1)
    c12 += product
    c22 += product
    product = _strassen(a22, b21 - b11, levels - 1)
    c11 += product
    c21 += product
    product = _strassen(a11 + a12, b22, levels - 1)
    c11 -= product
    c12 += product
    c22 += _strassen(a21 - a11, b11 + b12, levels - 1)
    c11 += _strassen(a12 - a22, b21 + b22, levels - 1)
    return out


def digitised(vectors: DataFrame, label: Column, scale: float, id: str = "vec_id",
              vector: str = "embedding") -> DataFrame:
    """(vec_id, label, x): the rows that take part, components as floor(scale * component)."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    digits = F.transform(x, lambda c: F.floor(F.greatest(
        F.lit(-float(HUGE)), F.least(F.lit(float(HUGE)), c * scale))).cast("bigint"))
    return vectors.where(F.col(vector).isNotNull() & label.isNotNull() & finite).select(
        F.col(id).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        digits.alias("x"))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (row, vec_id, label, x) packed by `size`; none moves. A block is named by its first row.

    Shorter vectors end in zeros. `most` is the largest Euclidean norm in the block, `bytes` the size
    of an integer of `x`, the least that holds them all.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + len(batch)
            if n >= size:
                together = pd.concat(held, ignore_index=True)
                for begin in range(0, n - size + 1, size):
                    yield packed(together[begin:begin + size])
                held, n = [together[n - n % size:]], n % size
        if n:
            yield packed(pd.concat(held, ignore_index=True))

    return in_small_batches(rows).mapInPandas(pack, BLOCK)


def packed(rows: pd.DataFrame) -> pd.DataFrame:
    matrix = np.zeros((len(rows), max(map(len, rows["x"]))), np.int64)
    for i, x in enumerate(rows["x"]):
        matrix[i, :len(x)] = x
    number = rows["row"].to_numpy(np.int64)
    low, high = matrix.min(initial=0), matrix.max(initial=0)
    kind = next(t for t in map(np.dtype, ("i1", "i2", "i4", "i8"))
                if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    columns = {"row": number, "label": rows["label"].to_numpy(np.int64),
               "vec_id": rows["vec_id"].astype("Int64").fillna(0).to_numpy(np.int64),
               "no_id": rows["vec_id"].isna().to_numpy(bool), "x": matrix.astype(kind)}
    return pd.DataFrame({
        "block": [number[0]], "height": len(rows), "width": matrix.shape[1], "bytes": kind.itemsize,
        "most": np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1)).max()}
        | {name: [value.tobytes()] for name, value in columns.items()})


class Block:
    """One side of a tile, its rows in the order in which ties are settled: by id, null ids last."""

    def __init__(self, tile: dict, side: str):
        row, label, vec_id = (np.frombuffer(tile[f"{side}_{c}"], np.int64)
                              for c in ("row", "label", "vec_id"))
        no_id = np.frombuffer(tile[f"{side}_no_id"], bool)
        x = np.frombuffer(tile[f"{side}_x"], f"i{tile[f'{side}_bytes']}").astype(np.int64).reshape(
            tile[f"{side}_height"], tile[f"{side}_width"])
        order = np.lexsort((row, vec_id, no_id))
        self.row, self.label, self.vec_id, self.no_id, self.x = (
            v[order] for v in (row, label, vec_id, no_id, x))
        self.most = tile[f"{side}_most"]


def scores(a: Block, b: Block) -> np.ndarray:
    """Inner products of the rows of two blocks. Where one may not fit a long, Python integers
    take the same recursion, and what does not fit becomes the nearest long."""
    width = max(a.x.shape[1], b.x.shape[1])
    one, two = (np.pad(s.x, ((0, 0), (0, width - s.x.shape[1]))) for s in (a, b))
    if a.most * b.most < 2.0**62:
        return strassen(one, np.ascontiguousarray(two.T))
    whole = strassen(one.astype(object), two.T.astype(object))
    return np.clip(whole, -LONGEST - 1, LONGEST).astype(np.int64)


def tiles(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every anchor block beside every candidate block, a pair to a row, in the columns of both with
    `a_` and `b_` before their names.

    A task has a partition of either side, and for each of its anchor blocks all its candidate blocks
    one after the other. Blocks are read where they lie. Without the hint Spark may broadcast a side.
    """
    one, two = (side.select(*[F.col(c).alias(f"{name}_{c}") for c in side.columns])
                for name, side in (("a", anchors), ("b", candidates)))
    return in_small_batches(one.crossJoin(two.hint("shuffle_replicate_nl")))


def spread(rows: DataFrame, size: int, n: int, parts: int) -> DataFrame:
    """Rows in blocks of `size`, which are about `n`, dealt out evenly to `parts` partitions and kept."""
    return kept(blocks(rows.coalesce(max(1, n)), size).repartition(max(1, parts)))


def with_positives(anchors: DataFrame, found: DataFrame) -> DataFrame:
    """Anchor blocks with the first pass's rows, at most `positives` for each of ANCHORS rows, in
    arrays. Neither side is broadcast, both grow with the anchors."""
    of_block = found.groupBy(F.col("a").alias("block")).agg(F.collect_list(F.struct(
        F.col("anchor").alias("of"), F.col("row").alias("positive"),
        F.coalesce("vec_id", F.lit(0)).alias("positive_id"),
        F.col("vec_id").isNull().alias("positive_no_id"),
        F.col("score").alias("positive_score"))).alias("found"))
    arrays = of_block.select("block", *[F.col(f"found.{c}").alias(c) for c in POSITIVES])
    return kept(anchors.join(arrays.hint("merge"), "block").repartition(
        anchors.rdd.getNumPartitions()))


def heaps(tiled: DataFrame, keep: int, of_tile, of_anchors=None) -> DataFrame:
    """HEAPS rows, at most `keep` for each key of a task. `of_tile` gives, for the blocks of a tile,
    what `of_anchors` gives for the anchors and the heaps so far, sorted entries (~score, no_id,
    vec_id, row) by key; those of one anchor block merge as tiles go by."""

    def shown(a: int, held: dict) -> pd.DataFrame:
        rows = [(a, *key, ~entry[0], None if entry[1] else entry[2], entry[3])
                for key, heap in held.items() for entry in heap]
        return pd.DataFrame(rows, columns=HEAP_NAMES).astype(
            {"vec_id": "Int64", "positive_id": "Int64"})

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, now, held, wanted = None, None, {}, {}
        for batch in batches:
            for tile in batch.to_dict("records"):
                if tile["a_block"] != now:
                    if held:
                        yield shown(now, held)
                    a, now, held = Block(tile, "a"), tile["a_block"], {}
                    wanted = of_anchors(tile) if of_anchors else {}
                for key, heap in of_tile(a, Block(tile, "b"), wanted, held).items():
                    if key in held:
                        merge(held[key], heap, keep)
                    else:
                        held[key] = heap
        if held:
            yield shown(now, held)

    return tiled.mapInPandas(take, HEAPS)


def merge(held: list[tuple], more: list[tuple], keep: int) -> None:
    """The first `keep` of two sorted lists, in place of the one held."""
    for entry in more:
        if len(held) == keep:
            if entry >= held[-1]:
                return
            held.pop()
        insort(held, entry)


#: Columns of an anchor block with the positives of its rows, an array each.
POSITIVES = ("of", "positive", "positive_id", "positive_no_id", "positive_score")
HEAP_NAMES = ["a", "anchor", "anchor_id", "positive", "positive_id", "positive_score", "score",
              "vec_id", "row"]
HEAPS = ("a bigint, anchor bigint, anchor_id bigint, positive bigint, positive_id bigint, "
         "positive_score bigint, score bigint, vec_id bigint, row bigint")


def first(found: DataFrame, by: list[str], keep: int) -> DataFrame:
    """The heaps of all tasks merged: ranks from 1 to `keep`. Spark limits each task's part first."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def entries(block: Block, score: np.ndarray, at: np.ndarray) -> list[tuple]:
    return [*zip((~score).tolist(), block.no_id[at].tolist(), block.vec_id[at].tolist(),
                 block.row[at].tolist(), strict=True)]


def bar(heap: list[tuple] | None, keep: int) -> int:
    """The score below which nothing enters a heap any more."""
    return ~heap[-1][0] if heap and len(heap) == keep else -LONGEST - 1


def nearest(a: Block, b: Block, wanted: dict, held: dict, keep: int) -> dict[tuple, list[tuple]]:
    """Each anchor's `keep` best other rows of its label in a tile, if they can enter its heap."""
    products, out = scores(a, b), {}
    for i, score in enumerate(products):
        key = (int(a.row[i]), int(a.vec_id[i]), 0, None, 0)
        at = np.flatnonzero(score >= bar(held.get(key), keep))
        at = at[(b.label[at] == a.label[i]) & (b.row[at] != a.row[i])]
        if not len(at):
            continue
        mine = ~score[at]
        if len(at) > keep:
            some = mine <= np.partition(mine, keep - 1)[keep - 1]
            at, mine = at[some], mine[some]
        order = np.argsort(mine, kind="stable")[:keep]
        out[key] = entries(b, ~mine[order], at[order])
    return out


def windows_of(tile: dict, least: int, most: int) -> dict[int, list[tuple]]:
    """(positive's row, id and score, least, most score) by the row of an anchor."""
    found: dict[int, list[tuple]] = {}
    for anchor, row, vec_id, no_id, of in zip(*(tile[f"a_{c}"].tolist() for c in POSITIVES),
                                              strict=True):
        # Scores from least * of / 100, rounded up, to most * of / 100, rounded down.
        low, high = -(-least * of // 100), min(most * of // 100, LONGEST)
        if low <= high:
            found.setdefault(anchor, []).append(
                ((row, None if no_id else vec_id, of), low, high))
    return found


def in_windows(a: Block, b: Block, wanted: dict, held: dict, keep: int) -> dict[tuple, list[tuple]]:
    """For each positive of each anchor, the `keep` best rows of other labels in its window, if they
    can enter its heap."""
    products, out = scores(a, b), {}
    for i, score in enumerate(products):
        mine, windows = (int(a.row[i]), int(a.vec_id[i])), []
        for positive, low, high in wanted.get(mine[0], ()):
            low = max(low, bar(held.get(key := mine + positive), keep))
            if low <= high:
                windows.append((key, low, high))
        if not windows:
            continue
        at = np.flatnonzero(score >= min(low for _, low, _ in windows))
        at = at[(score[at] <= max(high for *_, high in windows)) & (b.label[at] != a.label[i])]
        if not len(at):
            continue
        down = ~score[at]
        order = np.argsort(down, kind="stable")
        down, at = down[order], at[order]
        begins = np.searchsorted(down, np.array([~high for *_, high in windows]), side="left")
        ends = np.searchsorted(down, np.array([~low for _, low, _ in windows]), side="right")
        ends = np.minimum(ends, begins + keep)
        head, tail = begins.min(), ends.max()
        found = entries(b, ~down[head:tail], at[head:tail])
        for (key, _, _), begin, end in zip(windows, (begins - head).tolist(),
                                           (ends - head).tolist(), strict=True):
            if begin < end:
                out[key] = found[begin:end]
    return out


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, positives: int = 5,
                   negatives: int = 10, least: int = 30, most: int = 90, scale: float = 256.0,
                   id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Hard negatives of each anchor and positive: (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score).

    Rows with a null label, a null vector, or a null or non-finite component take no part. A score is
    the inner product of the components times `scale`, rounded down; higher ones come first, ties by
    smaller id, null ids last. Anchors are the rows for which `anchor`, of the id, holds. Positives are
    the first `positives` other rows of the label, negatives the first `negatives` rows of
    other labels with least * positive_score <= 100 * score <= most * positive_score. Rows that repeat
    an id, or a whole row, stay apart: each is an anchor and a candidate of its own. Missing
    components of shorter vectors are zero; components beyond 2**62 count as that, scores beyond a long
    as its limits. An empty table, or one without anchors, gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    place = folder(spark, "hardneg")
    digitised(vectors, label, scale, id, vector).withColumn(
        "row", F.monotonically_increasing_id()).write.parquet(f"{place}/rows")
    rows = spark.read.parquet(f"{place}/rows")
    chosen = rows.where(F.coalesce(anchor, F.lit(False)))
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    n_anchors, n_candidates = -(-chosen.count() // ANCHORS), -(-n // CANDIDATES)
    per_task = max(1, min(n_anchors * n_candidates // TASKS,
                          TASK_BYTES // (8 * max(1, width) * CANDIDATES)))
    anchors = spread(chosen, ANCHORS, n_anchors, min(SPLITS, n_anchors))
    candidates = spread(rows, CANDIDATES, n_candidates, -(-n_candidates // per_task))
    first(heaps(tiles(anchors, candidates), positives, lambda *tile: nearest(*tile, positives)),
          ["anchor"], positives).write.parquet(f"{place}/positives")
    release(spark)
    tiled = tiles(with_positives(anchors, spark.read.parquet(f"{place}/positives")), candidates)
    windows = heaps(tiled, negatives, lambda *tile: in_windows(*tile, negatives),
                    lambda tile: windows_of(tile, least, most))
    return first(windows, ["anchor", "positive"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
