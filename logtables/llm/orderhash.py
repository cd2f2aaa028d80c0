"""Near copies by Order MinHash: several minima of a text's shingles, in the order of the text.

A shingle is five consecutive words with the number of its earlier occurrences in the text. For each
of REPEATS hash functions, a text's sketch has the shingles with the MINIMA smallest hashes, listed as
they stand in the text. Texts that agree in a sketch are candidates, and so are short texts that agree in
one of the first shingles of a common order, which none within the similarity can miss; a banded
alignment of their shingles decides. Texts of equal words are one text with several documents throughout.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.components import connected
from logtables.llm.shared import in_small_batches, kept, release

#: Texts that agree to SIMILARITY share one of the REPEATS sketches with a probability of 0.9999 or more
#: if both have over FEW shingles; if one has fewer, they always share a bucket (see `first_shingles`).
WORDS, MINIMA, REPEATS, SIMILARITY, FEW = 5, 3, 16, 0.8, 16
#: Words whose shingles are hashed at once; a longer text is hashed as one.
STRETCH = 1 << 17
#: Buckets of up to SMALL texts list their pairs; larger ones are compared by blocks of about BLOCK.
SMALL, BLOCK = 32, 192
#: Shingles whose overlaps are counted at once.
COLUMNS = 8192
#: The id that stands for a null one.
LEAST = -(1 << 63)
BASE = np.uint64(0x9E3779B97F4A7C15)
SKETCHES = "id bigint, tag bigint, same binary, size int, sketches array<bigint>"


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        row = np.full(n + 1, base, np.uint64)
        row[0] = 1
        with np.errstate(over="ignore"):
            return np.cumprod(row, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (self._row(b, n) for b in (int(BASE), pow(int(BASE), -1, 1 << 64)))
        return self.up, self.down


WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
POWERS = Powers()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the place of each text's first (plus the end).

    Words are runs of ASCII letters, digits and characters beyond ASCII, in lower case.
    """
    raw = [t.lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    inside = WORD_BYTE[data]
    edge = np.diff(inside.view(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = POWERS.get(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        words = mixed((sums[ends] - sums[starts]) * down[starts])
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    return words, np.searchsorted(starts, bounds)


def shingles(words: np.ndarray, places: np.ndarray, width: int = WORDS
             ) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and their places. A text with fewer words is one shingle."""
    sizes = np.diff(places)
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    out_places = np.concatenate([[0], np.cumsum(counts)])
    first = np.arange(out_places[-1]) - np.repeat(out_places[:-1] - places[:-1], counts)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    end = np.repeat(places[1:], counts)
    out = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + np.where(
                first + k < end, padded[first + k], np.uint64(k + 1))
    return mixed(out), out_places


def with_occurrence(found: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Shingles told apart by how often they came before in their text."""
    owner = np.repeat(np.arange(len(places) - 1, dtype=np.uint64), np.diff(places))
    with np.errstate(over="ignore"):
        mine = found ^ mixed(owner + np.uint64(1))
    order = np.argsort(mine, kind="stable")
    again = np.concatenate([[False], mine[order][1:] == mine[order][:-1]])
    if not again.any():
        return found
    run = np.arange(len(found)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(found))))
    occurrence = np.empty(len(found), np.uint64)
    occurrence[order] = run
    with np.errstate(over="ignore"):
        return np.where(occurrence > 0, mixed(found + occurrence * BASE), found)


def order_sketches(labelled: np.ndarray, places: np.ndarray, repeats: int = REPEATS,
                   minima: int = MINIMA) -> np.ndarray:
    """For each text (row) and hash function, one number for its minima in text order."""
    sizes = np.diff(places)
    full = np.flatnonzero(sizes > 0)
    out = np.zeros((len(sizes), repeats), np.uint64)
    if not len(full):
        return out
    begin, size = places[:-1][full], sizes[full]
    # Only hashes below a text's limit can be among its smallest: some 6 times as many as are asked
    # for. The rare text with fewer of them is looked at whole.
    share = np.minimum(6.0 * minima / size, 1.0)
    limit = np.where(share < 1, share * 2.0**64, 2.0**64 - 2.0**11).astype(np.uint64)
    limits, owner = np.repeat(limit, size), np.repeat(np.arange(len(full)), size)
    limits[np.repeat(share >= 1, size)] = np.uint64(0xFFFFFFFFFFFFFFFF)
    for r in range(repeats):
        with np.errstate(over="ignore"):
            value = mixed(labelled + np.uint64(r + 1) * BASE)
        at = np.flatnonzero(value <= limits)
        found = np.bincount(owner[at], minlength=len(full))
        few = np.flatnonzero(found < np.minimum(minima, size))
        if len(few):
            more = np.concatenate([np.arange(b, b + n) for b, n in zip(
                begin[few], size[few], strict=True)])
            at = np.concatenate([at[~np.isin(owner[at], few)], more])
        at = at[np.lexsort((value[at], owner[at]))]
        rank = np.arange(len(at)) - np.searchsorted(owner[at], owner[at])
        at = np.sort(at[rank < minima])
        rank = np.arange(len(at)) - np.searchsorted(owner[at], owner[at])
        sketch = np.full(len(full), r + 1, np.uint64)
        with np.errstate(over="ignore"):
            for m in range(minima):
                use = at[rank == m]
                sketch[owner[use]] = mixed(sketch[owner[use]] * BASE + labelled[use])
        out[full, r] = sketch
    return out


def first_shingles(labelled: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The shingles of a text, hashed, that come first in the order of their hashes: so many that
    every text within `similarity` has one of them among its own first ones.

    Two such texts have a share of `similarity` of the shingles of each in common. So the first of
    the common ones has no more than the others, 1 - `similarity`, before it in either text.
    """
    need = int(np.ceil(similarity * len(labelled) - 1e-9))
    return np.sort(mixed(labelled))[:len(labelled) - need + 1]


def portions(texts: list[str], size: int = 6 * STRETCH) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about `size` characters, with the number of the first."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield begin, texts[begin:i]
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def bucket_names(labelled: np.ndarray, places: np.ndarray, similarity: float = SIMILARITY
                 ) -> list[np.ndarray]:
    """What each text is compared by: its sketches if it has over FEW shingles, its first shingles
    if it may be near to a text that has not. Texts between have both."""
    out = list(order_sketches(labelled, places))
    sizes = np.diff(places)
    for i in np.flatnonzero((sizes > 0) & (similarity * sizes <= FEW + 1e-9)):
        first = first_shingles(labelled[places[i]:places[i + 1]], similarity)
        out[i] = np.concatenate([out[i], first]) if sizes[i] > FEW else first
    return out


def sketched(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id, tag, same, size, sketches) of (id, tag, text); `same` is a digest of the words, `size`
    the number of shingles, `sketches` has the names of the text's buckets."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, own = batch["text"].tolist(), batch[["id", "tag"]]
            for begin, part in portions(texts):
                words, places = word_hashes(part)
                found, at = shingles(words, places)
                out = bucket_names(with_occurrence(found, at), at, similarity)
                yield pd.DataFrame({
                    "id": own["id"].to_numpy()[begin:begin + len(part)],
                    "tag": own["tag"].to_numpy()[begin:begin + len(part)],
                    "same": [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest()
                             for a, b in zip(places[:-1], places[1:], strict=True)],
                    "size": np.diff(at).astype(np.int32), "sketches": [names.view(np.int64) for names in out]})

    return docs.mapInPandas(sketch, SKETCHES)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sequences agree in order: matches / (all - matches) reaches `similarity`.

    The longest common subsequence is found within the band of diagonals that a sufficient
    alignment cannot leave, in memory proportional to the lengths.
    """
    total = len(a) + len(b)
    if not total:
        return True
    # matches m must satisfy m >= similarity * (total - m).
    need = int(np.ceil(similarity * total / (1 + similarity) - 1e-9))
    band = total - 2 * need
    if min(len(a), len(b)) < need:
        return False
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short -= head
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short]) if short else []
    tail = int(differ[0]) if len(differ) else short
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    need -= head + tail
    if need <= 0:
        return True
    if min(len(a), len(b)) < need:
        return False
    # No more places can match than have a partner anywhere; in most false pairs too few do.
    if min(np.isin(a, b).sum(), np.isin(b, a).sum()) < need:
        return False
    return _matches(a.tolist(), b.tolist(), band) >= need


def _matches(a: list[int], b: list[int], band: int) -> int:
    """Longest common subsequence of matches at most `band` places apart.

    One bit per place of `b` is kept for the 2 * band + 1 places that the current place of `a` may
    meet, whatever the lengths. A bit is cleared where a match ends a longer subsequence. Places
    below the window can change no more and are counted as they leave; those above were never met.
    """
    width = 2 * band + 1
    ones = (1 << width) - 1
    where: dict[int, list[int]] = {token: [] for token in a}
    for j, token in enumerate(b):
        if token in where:
            where[token].append(j)
    open_, base, matched = ones, -band, 0
    for i, token in enumerate(a):
        at = where[token]
        first, last = bisect_left(at, i - band), bisect_right(at, i + band)
        if first == last:
            continue
        if away := min(i - band - base, width):
            matched += away - (open_ & (1 << away) - 1).bit_count()
            open_ = open_ >> away | (1 << away) - 1 << width - away
        base = i - band
        hit = 0
        for j in at[first:last]:
            hit |= 1 << j - base
        both = open_ & hit
        open_ = (open_ + both | open_ - both) & ones
    return matched + width - open_.bit_count()


def verified(pairs: DataFrame, tokens: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose texts align, each pair with both texts' words in one row."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for one, other in zip(batch["words_a"], batch["words_b"], strict=True):
                sides = [shingles(w.astype(np.uint64), np.array([0, len(w)]))[0]
                         for w in (np.frombuffer(one, "<u4"), np.frombuffer(other, "<u4"))]
                good.append(aligned(*sides, similarity))
            yield batch.loc[good, ["a", "b"]]

    both = (pairs.join(tokens.select(F.col("id").alias("b"), F.col("words").alias("words_b")), "b")
            .join(tokens.select(F.col("id").alias("a"), F.col("words").alias("words_a")), "a"))
    return both.select("a", "b", "words_a", "words_b").mapInPandas(check, "a bigint, b bigint")


def candidates(texts: DataFrame) -> DataFrame:
    """Buckets with two texts and more: (bucket, id, size, weight).

    A text's weight is the number of texts it meets, over all buckets: of a group of copies, the
    one that the others were made from meets most.
    """
    every = texts.select("id", "size", F.explode("sketches").alias("bucket"))
    full = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = every.join(full, "bucket")
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))
    return members.join(weights, "id").select("bucket", "id", "size", "weight")


def _pairs(rows: DataFrame, done: DataFrame | None, similarity: float) -> DataFrame:
    """Distinct (a, b) from rows with two ids, sizes and labels that may still be linked."""
    near = rows.where((F.col("label") != F.col("label_2")) & (
        F.least("size", "size_2") >= similarity * F.greatest("size", "size_2")))
    found = near.select(F.least("id", "id_2").alias("a"), F.greatest("id", "id_2").alias("b"))
    found = found.distinct()
    return found if done is None else found.join(done, ["a", "b"], "left_anti")


def links(members: DataFrame, tokens: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Components (id, label) of the texts that have a partner.

    First each bucket compares its members with its hub, the heaviest one: copies of one text are
    joined by that, at a cost in proportion to their number. What is left are the pairs of a bucket
    in different components. In small buckets they are listed and compared; large buckets are
    cut into blocks, and each pair of blocks is compared in one task (see `compare_blocks`). Nothing
    is left out but pairs that a path of links joins anyway.
    """
    ids = members.select("id").distinct()
    labels = kept(ids.select("id", F.col("id").alias("label")))
    hubs = members.groupBy("bucket").agg(F.max(F.struct(
        "weight", (-F.col("id")).alias("first"), "id", "size")).alias("hub")).select(
        "bucket", F.col("hub.id").alias("id_2"), F.col("hub.size").alias("size_2"))
    first = members.join(hubs, "bucket").withColumns(
        {"label": F.col("id"), "label_2": F.col("id_2")})
    pairs = kept(_pairs(first, None, similarity))
    labels = connected(labels, kept(verified(pairs, tokens, similarity)))

    own = members.join(labels, "id")
    counts = own.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    open_ = kept(counts.groupBy("bucket").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"), F.sum("n").alias("n"),
        F.count("*").alias("kinds")).where("kinds > 1").drop("kinds"))
    small, large = open_.where(F.col("n") <= SMALL), open_.where(F.col("n") > SMALL)
    rest = own.join(small.select("bucket", "main"), "bucket").where("label != main").select(
        "bucket", F.col("id").alias("id_2"), F.col("size").alias("size_2"),
        F.col("label").alias("label_2"))
    found = verified(kept(_pairs(own.join(rest, "bucket"), pairs, similarity)), tokens, similarity)
    return connected(labels, kept(found.unionByName(_by_blocks(own, large, tokens, similarity))))


def _by_blocks(own: DataFrame, large: DataFrame, tokens: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) in large buckets: every member meets every block of its bucket once."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    dealt = own.join(large.select("bucket", blocks.alias("blocks")), "bucket").withColumn(
        "mine", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))
    met = dealt.select("bucket", "id", "label", "mine", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "bucket", "id", "label", "mine", F.least("mine", "other").alias("one"),
        F.greatest("mine", "other").alias("two"))
    return met.join(tokens, "id").groupBy("bucket", "one", "two").applyInPandas(
        lambda key, group: compare_blocks(group, key[1], key[2], similarity),
        "a bigint, b bigint")


def overlaps(found: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the (distinct) sequences have in common."""
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    _, code, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    # Shingles of one text only are in no overlap; the others by some thousand at a time.
    use = count[code] > 1
    name = np.cumsum(count > 1) - 1
    owner, code = owner[use], name[code[use]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((len(found), len(found)), np.float32)
    for begin in range(0, int((count > 1).sum()), COLUMNS):
        a, b = np.searchsorted(code, [begin, begin + COLUMNS])
        held = np.zeros((len(found), COLUMNS), np.float32)
        held[owner[a:b], code[a:b] - begin] = 1
        out += held @ held.T
    return out.astype(np.int64)


def compare_blocks(group: pd.DataFrame, one: int, two: int, similarity: float) -> pd.DataFrame:
    """Links between two blocks of a bucket, or within one.

    The shingles two texts have in common bound their alignment from above; where the bound is
    enough and no link found here joins the two already, they are aligned.
    """
    group = group.sort_values("id", ignore_index=True)
    words = [np.frombuffer(w, "<u4").astype(np.uint64) for w in group["words"]]
    plain = [shingles(w, np.array([0, len(w)]))[0] for w in words]
    common = overlaps([with_occurrence(p, np.array([0, len(p)])) for p in plain])
    sizes = np.array([len(p) for p in plain])
    total = sizes[:, None] + sizes[None]
    enough = common >= np.ceil(similarity * total / (1 + similarity) - 1e-9)
    mine = group["mine"].to_numpy()
    enough &= np.triu(np.ones_like(enough), 1)
    if one != two:
        enough &= mine[:, None] != mine[None]
    parent = {label: label for label in group["label"].tolist()}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    ids, labels, good = group["id"].tolist(), group["label"].tolist(), []
    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(enough)), strict=True):
        x, y = top(labels[i]), top(labels[j])
        if x != y and aligned(plain[i], plain[j], similarity):
            good.append((ids[i], ids[j]))
            parent[x] = y
    return pd.DataFrame(good, columns=["a", "b"], dtype="int64")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                similarity: float = SIMILARITY) -> DataFrame:
    """The class of near copies of each document: (key, class_id, kept, text_hash).

    Classes are the components of documents whose five-word shingles align to `similarity` or more;
    `class_id` is the smallest key in the class, and the document that has it is kept, of several
    texts with it the one with the smallest `text_hash` (xxhash64 of the text). Null text is empty;
    texts without words are one class, and a text of under five words is near only to texts of the
    same words. A null key counts as the smallest. One row per row: repeated rows have equal
    results. An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text), F.lit(""))
    rows = in_small_batches(docs).select(F.coalesce(F.col(key).cast("bigint"), F.lit(LEAST)).alias("id"),
                       F.xxhash64(text).alias("tag"), text.alias("text"))
    found = kept(sketched(rows, similarity))
    # One document stands for all with the same words.
    stand_ins = kept(found.groupBy("same").agg(
        F.min(F.struct("id", "tag")).alias("first"), F.max("size").alias("size"),
        F.first("sketches").alias("sketches"))
        # Written with them, so a text keeps its number.
        .withColumn("text_id", F.monotonically_increasing_id()))
    named = stand_ins.select("same", "first", F.col("text_id").alias("id"))
    members = kept(candidates(stand_ins.where("size > 0").select(
        F.col("text_id").alias("id"), "size", "sketches")))
    chosen = named.join(members.select("id").distinct(), "id").select(
        F.col("id").alias("text_id"), F.col("first.id").alias("id"), F.col("first.tag").alias("tag"))
    tokens = kept(_tokens(rows.join(chosen, ["id", "tag"])))
    release(docs.sparkSession)
    labels = links(members, tokens, similarity)
    classes = named.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = classes.groupBy("label").agg(F.min("first").alias("class"))
    by_text = classes.join(least, "label").select("same", "class")
    return found.select("id", "tag", "same").join(by_text, "same").select(
        F.when(F.col("id") != LEAST, F.col("id")).alias(key),
        F.when(F.col("class.id") != LEAST, F.col("class.id")).alias("class_id"),
        ((F.col("id") == F.col("class.id")) & (F.col("tag") == F.col("class.tag"))).alias("kept"),
        F.col("tag").alias("text_hash"))


def _tokens(rows: DataFrame) -> DataFrame:
    """(id, words): the word hashes of the texts, cut to 32 bits, by the id of the text."""

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["text_id"].to_numpy()
            for begin, part in portions(batch["text"].tolist()):
                words, places = word_hashes(part)
                yield pd.DataFrame({
                    "id": ids[begin:begin + len(part)],
                    "words": [words[a:b].astype("<u4").tobytes()
                              for a, b in zip(places[:-1], places[1:], strict=True)]})

    return rows.select("text_id", "text").mapInPandas(
        tokenize, "id bigint, words binary").dropDuplicates(["id"])
