"""Best-fit packing of token sequences by linear grouping.

A plan needs only how many pieces there are of each length, so it is made on the driver from a
histogram with at most `capacity` rows, however many documents there are. The documents find their
places from the plan in parallel, by their rank among pieces of the same length.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.shared import in_small_batches, kept, ranked

CAPACITY = 2048
#: Pieces above this share of the capacity are large: they are grouped and configured.
LARGE = 1 / 3
#: Groups of equal cardinality, hence sizes that configurations are made of.
GROUPS = 64
#: Configurations less full than this are not used; their pieces are left to best fit.
TIGHT = 0.985
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def encoder() -> tiktoken.Encoding:
    """The vocabulary of `byte_bpe_50k`, from its rank file; ids equal those of the JSON file, whose
    added tokens are special here: `encode` with all of them allowed finds them in a text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens=added)


class Encoder:
    """Ids of whole texts.

    The pattern of pre-tokens backtracks once per character of a run of blanks, and on a very long
    run the fast encoder gives up. Such a text, by its own failure, goes to `tokenizers`, which
    gives the same ids for any text.
    """

    def __init__(self):
        self.fast, self.whole = encoder(), None

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:
            if self.whole is None:
                self.whole = tokenizers.Tokenizer.from_file(
                    str(public_tokenizers.path("byte_bpe_50k.json")))
            return self.whole.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces: a text's ids, then `end_id`, cut into pieces of `capacity` from the end.

    Null text is empty and has the one id. Very long texts are encoded whole, unbroken runs of blanks
    too.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder().ids
        for batch in batches:
            out = []
            for doc, body in zip(batch["id"], batch["text"], strict=True):
                ids = np.array([*encode(body), end_id], "<u4")
                first = len(ids) % capacity or min(capacity, len(ids))
                for n, end in enumerate(range(first, len(ids) + 1, capacity)):
                    begin = max(0, end - capacity) if n else 0
                    out.append((doc, n, begin, end - begin,
                                zlib.crc32(ids[begin:end].tobytes())))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]
                               ).astype({"doc_id": "Int64"})

    texts = in_small_batches(docs).select(F.col(key).cast("bigint").alias("id"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.mapInPandas(cut, PIECES)


class Plan:
    """Bins as blocks of equal ones: what each block holds, in terms of ranks within a length.

    `blocks` are lists [count, free, content]; content has (length, first rank, per bin): the
    block's bin i holds the ranks from first + i * per bin on.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.used: dict[int, int] = defaultdict(int)
        self.blocks: list[list] = []

    def take(self, length: int, number: int) -> int:
        first = self.used[length]
        self.used[length] += number
        self.left[length] -= number
        return first

    def configure(self, groups: list[list[int]], patterns: list[tuple[np.ndarray, int]]) -> None:
        """Substitute actual pieces for the rounded sizes of each configuration.

        A slot of a group takes any piece of the group, since none is above the rounded size. The
        bins of a configuration stay one block while all slots go on with the same lengths.
        """
        queues = [[n for n in sorted(group, reverse=True) if self.left[n]] for group in groups]
        for slots, bins in patterns:
            names = [g for g in np.flatnonzero(slots) for _ in range(slots[g])]
            while bins > 0:
                content, taken = [], defaultdict(int)
                for g in names:
                    at = next((n for n in queues[g] if self.left[n] > taken[n]), None)
                    if at is not None:
                        taken[at] += 1
                if not taken:
                    return
                run = min([bins, *(self.left[n] // k for n, k in taken.items())])
                for n, k in taken.items():
                    content.append((n, self.take(n, run * k), k))
                for q in queues:
                    while q and not self.left[q[0]]:
                        q.pop(0)
                size = sum(n * k for n, k in taken.items())
                self.blocks.append([run, self.capacity - size, content])
                bins -= run

    def fit(self, length: int) -> None:
        """Best fit for all pieces of a length: the fullest bins that can take one come first.

        The same bin stays the best one for the next equal piece until it can take no more, so a
        block of bins is served at once; at most two blocks are split off for a length.
        """
        index = sorted((b[1], i) for i, b in enumerate(self.blocks) if b[1] >= length)
        for free, i in index:
            if not self.left[length]:
                return
            self.fill(i, length, free // length)
        while self.left[length]:
            each = self.capacity // length
            bins = max(1, self.left[length] // each)
            self.blocks.append([bins, self.capacity, []])
            self.fill(len(self.blocks) - 1, length, each)

    def fill(self, i: int, length: int, each: int) -> None:
        count, free, content = self.blocks[i]
        whole = min(count, self.left[length] // each)
        if whole < count:  # split: full ones, one partly filled, the rest as they were
            part = min(self.left[length] - whole * each, each)
            if part:
                one = self.split(i, whole, 1)
                self.put(one, length, part)
            if count - whole - bool(part):
                self.split(i, whole + bool(part), count - whole - bool(part))
        if whole:
            self.blocks[i][0] = whole
            self.put(i, length, each)
        elif whole < count:
            self.blocks[i][0] = 0

    def split(self, i: int, skip: int, count: int) -> int:
        _, free, content = self.blocks[i]
        self.blocks.append([count, free, [(n, first + skip * k, k) for n, first, k in content]])
        return len(self.blocks) - 1

    def put(self, i: int, length: int, each: int) -> None:
        block = self.blocks[i]
        first = self.take(length, block[0] * each)
        block[1] -= length * each
        block[2] = [*block[2], (length, first, each)]


def equal_groups(counts: dict[int, int], groups: int) -> list[list[int]]:
    """Lengths in descending order, cut into groups of (nearly) equal numbers of pieces."""
    total, seen, out = sum(counts.values()), 0, defaultdict(list)
    for length in sorted(counts, reverse=True):
        out[seen * groups // max(1, total)].append(length)
        seen += counts[length]
    return list(out.values())


def configurations(sizes: list[int], demand: list[int], capacity: int,
                   rounds: int = 500) -> list[tuple[np.ndarray, int]]:
    """Bins for few sizes: a linear programme by column generation, rounded down.

    Each column is a configuration; a knapsack over the duals finds one that improves. The pieces
    that rounding down leaves over are at most a bin's content for each size. After `rounds`
    columns it stops with what it has, which is a packing too.
    """
    size, need = np.array(sizes), np.array(demand, float)
    k = len(size)
    columns = np.diag(capacity // size).astype(float)
    inverse = np.linalg.inv(columns)
    amounts = inverse @ need
    for _ in range(rounds):
        duals = np.ones(k) @ inverse
        best = np.zeros(capacity + 1)
        choice = np.full(capacity + 1, -1)
        for room in range(int(size.min()), capacity + 1):
            fits = size <= room
            values = np.where(fits, best[room - size * fits] + duals, 0.0)
            at = int(values.argmax())
            best[room], choice[room] = best[room - 1], -1
            if values[at] > best[room] + 1e-12:
                best[room], choice[room] = values[at], at
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        while room >= size.min():
            if choice[room] < 0:
                room -= 1
                continue
            column[choice[room]] += 1
            room -= int(size[choice[room]])
        moved = inverse @ column
        limits = np.where(moved > 1e-9, amounts / np.where(moved > 1e-9, moved, 1), np.inf)
        out = int(limits.argmin())
        columns[:, out] = column
        inverse = np.linalg.inv(columns)
        amounts = np.maximum(inverse @ need, 0)
    return sorted(((columns[:, i].astype(int), int(amounts[i] + 1e-9)) for i in range(k)),
                  key=lambda p: -int((p[0] * size).sum()))


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY, large: float = LARGE,
              groups: int = GROUPS, tight: float = TIGHT) -> Plan:
    """The packing of so many pieces of each length; its cost does not depend on their number."""
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    plan = Plan(counts, capacity)
    if counts.get(capacity):
        plan.fit(capacity)
    big = {n: c for n, c in counts.items() if capacity * large < n < capacity and c > 0}
    if big:
        grouped = equal_groups(big, groups)
        sizes = [max(g) for g in grouped]
        found = configurations(sizes, [sum(big[n] for n in g) for g in grouped], capacity)
        plan.configure(grouped, [(slots, bins) for slots, bins in found
                                 if (slots * np.array(sizes)).sum() >= tight * capacity])
    for length in sorted(plan.left, reverse=True):
        if plan.left[length]:
            plan.fit(length)
    plan.blocks = [b for b in plan.blocks if b[0]]
    return plan


def places(plan: Plan) -> pd.DataFrame:
    """The plan by length and rank: which ranks lie in which bins, from which offset on."""
    rows, base = [], 0
    for count, _, content in plan.blocks:
        offset = 0
        for length, first, each in content:
            rows.append((length, first, each, base, offset))
            offset += length * each
        base += count
    return pd.DataFrame(rows, columns=["length", "first", "each", "base", "offset"]).sort_values(
        ["length", "first"], ignore_index=True).astype("int64")


def placed(rows: DataFrame, plan: Plan) -> DataFrame:
    """Add sequence_id and offset to rows with a length and a rank within it.

    The table of the plan is sent along with the function. It has a few rows per length of the
    capacity, whatever the number of documents.
    """
    table = places(plan)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, firsts = table["length"].to_numpy(), table["first"].to_numpy()
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        # Within a length the entries are sorted by rank: a search in (length, rank) order.
        keys = lengths.astype(np.float64) * 2.0**40 + firsts
        if len(firsts) and firsts.max() >= 1 << 40:
            raise ValueError("over 2**40 pieces of one length")
        at = np.searchsorted(keys, n.astype(np.float64) * 2.0**40 + r, side="right") - 1
        steps = r - firsts[at]
        each = table["each"].to_numpy()[at]
        return pd.DataFrame({"sequence_id": table["base"].to_numpy()[at] + steps // each,
                             "offset": table["offset"].to_numpy()[at] + steps % each * n})

    return rows.withColumn("_place", place("length", "_rank")).select(
        *[c for c in rows.columns if c != "_rank"], "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id",
         text: str = "text", make: Callable[..., DataFrame] = pieces) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null text is empty: one
    piece of one id. Null or repeated keys are packed like others, row by row. Ties between pieces
    of one length go by key and piece. An empty table gives no rows. Other columns are not read.
    Texts are encoded once; the narrow piece table is checkpointed and read for the histogram and
    for the ranks.
    """
    cut = kept(make(docs, capacity, end_id, key, text))
    counts = {int(r[0]): int(r[1]) for r in cut.groupBy("length").count().collect()}
    plan = plan_bins(counts, capacity)
    return placed(ranked(cut, "length", ["doc_id", "piece"], "_rank"), plan)
