"""Repeated passages by a distributed merge sort of suffixes.

A byte goes if it is covered by a string of SPAN bytes that also starts in a document with a smaller
id. So what counts of a suffix are its first SPAN bytes, here called a window. Four passes:

1. Windows that share an anchor, the k-gram with the smallest hash in them, form a chunk. Equal windows
   have equal anchors, wherever they are. Chunks meet by the hash of their anchor's k-gram.
2. Equal chunks: all but those of the smallest document go. A chunk whose k-gram other documents
   have too is contested if, besides, its surroundings agree on one side: a window holds half the
   rest of SPAN before or after its anchor. The windows of all other chunks occur nowhere else.
3. Contested chunks are sorted where their texts are, as suffixes from their anchors, and the runs
   are exchanged front-coded: what a suffix has in common with the one before it, and the rest.
   Chunks of one k-gram meet. Where a k-gram has very many, its windows are exchanged instead, in
   runs of their own and spread by their content.
4. Neighbours in the order of suffixes, and in that of what is before the anchors, tell how far a
   chunk can agree with any other; windows beyond that go. For that a task decodes the runs it was
   sent and sorts their suffixes as 64-bit words. The windows that are left form runs anew, which a
   loser tree merges that carries the common prefixes along; the exchanged runs themselves are
   merged so for k-grams with very many chunks. Equal windows become neighbours; all but the
   smallest document's go.

Equal chunks (2) are told by 88 bits of hash and not compared byte by byte.

Everything that moves is packed by task and destination; the texts move by blocks of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.orderhash import POWERS, mixed, portions
from logtables.llm.shared import in_small_batches, kept, release

SPAN = 50
#: Length of an anchor's k-gram; at least one lies in each window, chosen among SPAN - K + 1.
K = 20
#: Bytes that chunks are looked for in at once; a longer text is taken as one.
STRETCH = 1 << 17
#: Characters of text whose chunks a task sorts and sends together.
TOGETHER = 4 << 20
#: Chunks of one k-gram that a task sends on; if it has more, they are contested anyway and it sends
#: two as witnesses.
SAME_GRAM = 8
#: Bytes of text to a block of documents, and to a destination. A task holds one of either.
PART_BYTES = 8 << 20
#: The id that stands for a null one.
LEAST = -(1 << 63)
RECORD, GONE, CONTESTED, RUN, HOT, CHUNKS = 0, 1, 2, 3, 4, 5
#: Contested chunks of one k-gram that may meet in a task; the windows of more are spread.
MEETING = 256
#: Runs that a task merges chunks from.
RUNS = 8
PACKED = "kind int, part int, blob binary"
MARK = ("<i8", "<u4", "<u4")  # document, first window, number of windows


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one blob: bytes of equal weight together, then compressed."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
              for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    sizes = [np.dtype(t).itemsize for t in types]
    n, at, out = len(data) // sum(sizes), 0, []
    for kind, size in zip(types, sizes, strict=True):
        plane = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += n * size
    return out


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """The block of documents an id belongs to."""
    return (mixed(ids.astype(np.int64).view(np.uint64)) >> np.uint64(32)).astype(np.int64) % blocks


def by_part(kind: int, part: np.ndarray, arrays: list[np.ndarray]) -> Iterator[tuple]:
    """Rows (kind, part, blob) of arrays, dealt out by part in their order."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0, [True]]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        mine = order[a:b]
        yield kind, int(part[mine[0]]), pack(*[x[mine] for x in arrays])


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "part", "blob"]).astype(
        {"kind": "int32", "part": "int32"})


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the hash of any stretch [a, b): mixed((sums[b] - sums[a]) * down[a])."""
    up, down = POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums, down


def chunks(data: np.ndarray, bounds: np.ndarray, span: int, k: int) -> tuple[np.ndarray, ...]:
    """Chunks of concatenated texts: hash of the k-gram, hash of the chunk, start, windows, and a
    byte each for what is before and after the anchor, 0 where no window needs it."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64),
            np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint8))
    if len(data) < span:
        return none
    sums, down = prefix_sums(data)
    grams = len(data) - k + 1
    with np.errstate(over="ignore"):
        value = mixed((sums[k:] - sums[:-k]) * down[:grams])
    least, place = (value >> np.uint64(32)).astype(np.uint32), np.arange(grams, dtype=np.int32)
    width, wanted = 1, span - k + 1
    while width < wanted:
        step = min(width, wanted - width)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        width += step
    turn = np.zeros(len(data) + 1, np.int32)
    np.add.at(turn, bounds[:-1], 1)
    np.add.at(turn, np.maximum(bounds[:-1], bounds[1:] - span + 1), -1)
    window = np.flatnonzero(np.cumsum(turn[:len(place)]) > 0)
    if not len(window):
        return none
    anchor = place[window]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([first, [len(window)]]))
    start = window[first]
    with np.errstate(over="ignore"):
        content = mixed((sums[start + count + span - 1] - sums[start]) * down[start]
                        + count.astype(np.uint64))
        # A window reaches `side` bytes before its anchor or after its k-gram, one of the two.
        at, side = anchor[first].astype(np.int64), (span - k + 1) // 2
        before = np.where(at - start >= side, byte_of(sums, down, np.maximum(at - side, 0), side), 0)
        needs = at - (start + count - 1) <= span - k - side
        last = np.minimum(at + k, len(data) - side)
        after = np.where(needs, byte_of(sums, down, last, side), 0)
    # Anchors have small hashes; mixed again, they spread over all destinations.
    gram = mixed(~value[anchor[first]])
    return gram, content, start, count, before.astype("u1"), after.astype("u1")


def byte_of(sums: np.ndarray, down: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """1 to 255 by the hash of `size` bytes at each start."""
    return mixed((sums[start + size] - sums[start]) * down[start]) % np.uint64(255) + np.uint64(1)


def found_chunks(ids: np.ndarray, raw: list[bytes], span: int, k: int) -> list[np.ndarray]:
    """(k-gram, content, document, start, windows, before, after) of all chunks of the texts."""
    out, begin = [], 0
    while begin < len(raw):
        end, size = begin, 0
        while end < len(raw) and (end == begin or size + len(raw[end]) <= STRETCH):
            size += len(raw[end])
            end += 1
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw[begin:end]])])
        gram, content, start, count, *sides = chunks(
            np.frombuffer(b"".join(raw[begin:end]), np.uint8), bounds, span, k)
        owner = np.searchsorted(bounds, start, side="right") - 1
        out.append((gram, content, ids[begin:end][owner], start - bounds[owner], count, *sides))
        begin = end
    return [np.concatenate([o[i] for o in out]).astype(t)
            for i, t in enumerate(("<u8", "<u8", "<i8", "<u4", "<u4", "u1", "u1"))]


def settle(gram: np.ndarray, content: np.ndarray, doc: np.ndarray, *rest: np.ndarray
           ) -> tuple[np.ndarray, ...]:
    """Of chunks sorted by (gram, content, doc): which go, and, among those left, which are the
    first of their k-gram, where each k-gram has other chunks, and other documents."""
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    new = new_gram | np.concatenate([[True], content[1:] != content[:-1]])
    group = np.cumsum(new) - 1
    least = doc[np.flatnonzero(new)]
    gone = doc > least[group]
    return gone, new, new_gram


def of_batch(ids: np.ndarray, raw: list[bytes], span: int, k: int, parts: int) -> pd.DataFrame:
    """What a task sends on for its texts (pass 1): one document's chunks of each content."""
    found = found_chunks(ids, raw, span, k)
    found = [x[np.lexsort((found[2], found[1], found[0]))] for x in found]
    gram, content, doc, start, count, before, after = found
    if not len(gram):
        return frame([])
    gone, new, new_gram = settle(gram, content, doc)
    rows = list(by_part(GONE, block_of(doc[gone], parts), [doc[gone], start[gone], count[gone]]))
    left = ~gone
    # Distinct contents of each k-gram, counted along the sorted chunks.
    which = np.cumsum(new_gram) - 1
    kinds = np.bincount(which, weights=new).astype(np.int64)
    nth = np.cumsum(new) - np.cumsum(new)[np.flatnonzero(new_gram)][which]
    many = (kinds > SAME_GRAM)[which] & left
    rows += by_part(HOT, block_of(doc[many], parts), [doc[many], start[many], count[many]])
    send = left & (~many | (nth < 2))
    part = ((gram[send] >> np.uint64(44)).astype(np.int64) * parts) >> 20
    low = (gram[send] & np.uint64((1 << 44) - 1))
    rows += by_part(RECORD, part, [
        (low >> np.uint64(4)).astype("<u4"), (content[send] & np.uint64(0xFFFFFFFF)).astype("<u4"),
        (content[send] >> np.uint64(48)).astype("<u2"), doc[send], start[send],
        count[send].astype("u1") if span - k < 255 else count[send].astype("<u4"),
        many[send].astype("u1"), before[send], after[send]])
    return frame(rows)


def beside_others(gram: np.ndarray, content: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which chunks share their k-gram and what is on one side with a chunk of other content."""
    order = np.lexsort((content, side, gram))
    g, s, c = gram[order], side[order], content[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
    kinds = np.bincount(np.cumsum(new) - 1, weights=new | np.concatenate(
        [[True], c[1:] != c[:-1]]))
    out = np.empty(len(gram), bool)
    out[order] = (kinds > 1)[np.cumsum(new) - 1] & (s > 0)
    return out


def meet(blobs: list[bytes], span: int, k: int, parts: int) -> pd.DataFrame:
    """Chunks of the same k-grams from all tasks (pass 2): what goes, and what is contested."""
    count_type = "u1" if span - k < 255 else "<u4"
    types = ("<u4", "<u4", "<u2", "<i8", "<u4", count_type, "u1", "u1", "u1")
    tables = [unpack(b, *types) for b in blobs]
    gram, low, high, doc, start, count, witness, before, after = [
        np.concatenate([t[i] for t in tables]) for i in range(len(types))]
    content = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
    order = np.lexsort((doc, content, gram))
    gram, content, doc, start, count, witness, before, after = [
        x[order] for x in (gram, content, doc, start, count.astype("<u4"), witness, before, after)]
    gone, new, new_gram = settle(gram, content, doc)
    which = np.cumsum(new_gram) - 1
    first = np.flatnonzero(new_gram)
    several = (np.bincount(which, weights=new) > 1) & (
        np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first))
    beside = beside_others(gram, content, before) | beside_others(gram, content, after)
    # Witnesses stand for chunks with any surroundings.
    seen = np.maximum.reduceat(witness, first)[which] > 0
    beside |= seen
    hot = seen | (np.bincount(which, weights=new) > MEETING)[which]
    # Witnesses are contested already where they come from.
    contested = several[which] & beside & ~gone & (witness == 0)
    gone &= witness == 0
    rows = []
    for kind, use in ((GONE, gone), (CONTESTED, contested & ~hot), (HOT, contested & hot)):
        rows += by_part(kind, block_of(doc[use], parts), [doc[use], start[use], count[use]])
    return frame(rows)


def front_coded(windows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Sorted windows (rows) as the prefix each shares with the one before, and the rests."""
    common = np.zeros(len(windows), np.int64)
    if len(windows) > 1:
        differ = windows[1:] != windows[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), windows.shape[1])
    return common, windows[np.arange(windows.shape[1]) >= common[:, None]].tobytes()


class Run:
    """A front-coded sorted run, read from the front."""

    __slots__ = ("common", "rest", "span", "at", "offset", "size", "text")

    def __init__(self, common: list[int], rest: bytes, span: int):
        self.common, self.rest, self.span = common, rest, span
        self.at, self.offset, self.size, self.text = -1, 0, len(common), b""

    def step(self) -> int:
        """Go on to the next suffix; what it shares with the last one, or -1 at the end."""
        self.at += 1
        if self.at >= self.size:
            return -1
        common = self.common[self.at]
        end = self.offset + self.span - common
        self.text = self.text[:common] + self.rest[self.offset:end]
        self.offset = end
        return common


def merged(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """Merge runs: (run, place in the run, bytes shared with the suffix before) in sorted order.

    A node of the loser tree keeps the loser of its match and the prefix it shares with the winner.
    On the way up from the last winner's leaf, all these prefixes are with that same winner: the
    longer one is the smaller suffix, and only suffixes with equal prefixes are compared, from there
    on.
    """
    size = 1
    while size < max(1, len(runs)):
        size *= 2
    span = runs[0].span if runs else 0
    shared = [run.step() for run in runs] + [-1] * (size - len(runs))
    texts = [run.text for run in runs] + [b""] * (size - len(runs))

    def match(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser then holds what it shares with the winner."""
        x, y = shared[a], shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        one, other = texts[a], texts[b]
        one, other = one[x:], other[x:]
        if one == other:
            shared[b] = span
            return a, b
        apart = int.from_bytes(one) ^ int.from_bytes(other)
        same = span - (apart.bit_length() + 7) // 8
        if one < other:
            shared[b] = same
            return a, b
        shared[a] = same
        return b, a

    losers = [0] * size
    winners = [0] * (2 * size)
    for leaf in range(size):
        winners[size + leaf] = leaf
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = match(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if size > 1 else 0
    while shared[top] >= 0:
        run = runs[top]
        yield top, run.at, shared[top]
        shared[top] = run.step()
        texts[top] = run.text
        node = (size + top) // 2
        while node:
            top, losers[node] = match(top, losers[node])
            node //= 2


def block_texts(texts: dict[int, bytes], blobs: list[bytes]) -> tuple:
    """The texts that marks speak of, as one, and the marks: (ids, data, bounds, owner, start,
    count)."""
    doc, start, count = [np.concatenate(x) for x in zip(*[unpack(b, *MARK) for b in blobs],
                                                        strict=True)]
    known, owner = np.unique(doc, return_inverse=True)
    raw = [texts.get(int(d), b"") for d in known]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    return (known, np.frombuffer(b"".join(raw), np.uint8), bounds, owner,
            start.astype(np.int64), count.astype(np.int64))


def first_of_equal(windows: np.ndarray, doc: np.ndarray, start: np.ndarray, parts: int
                   ) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Sorted windows of the smallest document of each content; the others go at once."""
    order = order_windows(windows, doc)
    windows, doc, start = windows[order], doc[order], start[order].astype("<u4")
    new = np.concatenate([[True], (windows[1:] != windows[:-1]).any(axis=1)])
    gone = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    rows = list(by_part(GONE, block_of(doc[gone], parts), [
        doc[gone], start[gone], np.ones(int(gone.sum()), "<u4")]))
    return rows, windows[~gone], doc[~gone], start[~gone]


def sorted_runs(texts: dict[int, bytes], blobs: list[bytes], span: int, parts: int) -> list[tuple]:
    """Windows of hot chunks of a block of documents (pass 3), as runs for each destination."""
    known, data, bounds, owner, start, count = block_texts(texts, blobs)
    owner = np.repeat(owner, count)
    start = np.repeat(start, count) + (
        np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    inside = start + span <= np.diff(bounds)[owner]
    owner, start = owner[inside], start[inside]
    if not len(owner):
        return []
    windows = data[(bounds[owner] + start)[:, None] + np.arange(span)]
    rows, windows, doc, start = first_of_equal(windows, known[owner], start, parts)
    target = np.zeros(len(windows), np.uint64)
    for word in words_of(windows):
        target = mixed(target ^ word)
    target = (target >> np.uint64(33)).astype(np.int64) % parts
    for part in np.unique(target):
        mine = np.flatnonzero(target == part)
        rows.append((RUN, int(part), coded_run(windows[mine], doc[mine], start[mine])))
    return rows


def coded_run(rows: np.ndarray, *columns: np.ndarray) -> bytes:
    """A front-coded run with columns beside it."""
    common, rest = front_coded(rows)
    head = pack(common.astype("<u2"), *columns)
    return (len(head).to_bytes(8, "little") + head
            + zstandard.ZstdCompressor(level=1).compress(rest))


def decoded_run(blob: bytes, *types: str) -> tuple[list[int], bytes, list[np.ndarray]]:
    end = 8 + int.from_bytes(blob[:8], "little")
    common, *columns = unpack(blob[8:end], "<u2", *types)
    rest = zstandard.ZstdDecompressor().decompress(blob[end:]) if len(common) else b""
    return common.tolist(), rest, columns


CHUNK = ("<i8", "<u4", "<u2", "<u2")  # document, first window, bytes before the anchor, windows


def chunk_runs(texts: dict[int, bytes], blobs: list[bytes], span: int, k: int, parts: int
               ) -> list[tuple]:
    """Contested chunks of a block (pass 3): suffixes from the anchor, then what is before it
    backwards, sorted and front-coded for each destination."""
    known, data, bounds, owner, start, count = block_texts(texts, blobs)
    inside = start + count + span - 1 <= np.diff(bounds)[owner]
    owner, start, count = owner[inside], start[inside], count[inside]
    if not len(owner):
        return []
    size, reach = count + span - 1, span - k
    at = bounds[owner] + start
    longest = 2 * span - k
    held = np.zeros((len(at), longest), np.uint64)
    columns = np.arange(longest)
    real = columns < size[:, None]
    held[real] = data[(at[:, None] + columns)[real]]
    # The anchor lies in all of the chunk's windows and has the smallest hash there.
    powers = POWERS.get(k)[0][:k]
    before, gram = np.zeros(len(at), np.int64), np.zeros(len(at), np.uint64)
    least = np.full(len(at), 1 << 32, np.uint64)
    for place in range(reach + 1):
        with np.errstate(over="ignore"):
            value = mixed(((held[:, place:place + k] + np.uint64(1)) * powers).sum(
                axis=1, dtype=np.uint64))
        better = (value >> np.uint64(32) < least) & (place >= count - 1)
        least = np.where(better, value >> np.uint64(32), least)
        before, gram = np.where(better, place, before), np.where(better, value, gram)
    # From the anchor on, then backwards from it; zero where the chunk has no more.
    source = np.where(columns < span, before[:, None] + columns, before[:, None] - 1 - (
        columns - span))
    real = (source >= 0) & (source < size[:, None])
    suffix = np.where(real, np.take_along_axis(held, np.clip(source, 0, longest - 1), 1),
                      0).astype(np.uint8)
    target = (mixed(~gram) >> np.uint64(33)).astype(np.int64) % parts
    order = np.lexsort((*words_of(suffix)[::-1], target))
    doc = known[owner]
    edges = np.flatnonzero(np.concatenate([[True], np.diff(target[order]) != 0, [True]]))
    return [(CHUNKS, int(target[order[a]]), coded_run(
        suffix[order[a:b]], doc[order[a:b]], start[order[a:b]].astype("<u4"),
        before[order[a:b]].astype("<u2"), count[order[a:b]].astype("<u2")))
        for a, b in zip(edges[:-1], edges[1:], strict=True)]


def agreement(rows: np.ndarray, width: int) -> np.ndarray:
    """For sorted rows, the longest prefix each shares with a neighbour, hence with any other."""
    with_next = np.zeros(len(rows) + 1, np.int64)
    if len(rows) > 1:
        differ = rows[1:, :width] != rows[:-1, :width]
        with_next[1:-1] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.maximum(with_next[1:], with_next[:-1])


def merge_chunks(blobs: list[bytes], span: int, k: int, parts: int) -> list[tuple]:
    """Contested chunks of the same k-grams (pass 4): windows that may recur, in sorted runs."""
    longest, held, columns, source = 2 * span - k, [], [], []
    for i, blob in enumerate(blobs):
        common, rest, found = decoded_run(blob, *CHUNK)
        run = Run(common, rest, longest)
        while run.step() >= 0:
            held.append(run.text)
        columns.append(found)
        source.append(np.full(len(common), i % RUNS))
    suffix = np.frombuffer(b"".join(held), np.uint8).reshape(-1, longest)
    doc, start, before, count = [np.concatenate(x) for x in zip(*columns, strict=True)]
    source, before, count = np.concatenate(source), before.astype(np.int64), count.astype(np.int64)
    after, ahead = np.zeros(len(suffix), np.int64), np.zeros(len(suffix), np.int64)
    order = np.lexsort(words_of(suffix[:, :span])[::-1])
    after[order] = agreement(suffix[order], span)
    # What is before the anchors, among chunks of one k-gram.
    turned = np.concatenate([suffix[:, :k], suffix[:, span:]], axis=1)
    order = np.lexsort(words_of(turned)[::-1])
    ahead[order] = np.maximum(agreement(turned[order], turned.shape[1]) - k, -1)
    which = np.repeat(np.arange(len(suffix)), count)
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    back = before[which] - step
    able = (back <= ahead[which]) & (span - back <= after[which])
    which, step, back = which[able], step[able], back[able]
    rows, runs, docs, starts = [], [], [], []
    for i in range(RUNS):
        mine = np.flatnonzero(source[which] == i)
        if not len(mine):
            continue
        j, b = np.arange(span), back[mine][:, None]
        windows = np.take_along_axis(
            suffix[which[mine]], np.where(j < b, span + b - 1 - j, j - b), 1)
        more, windows, d, t = first_of_equal(
            windows, doc[which[mine]], start[which[mine]] + step[mine], parts)
        rows += more
        common, rest = front_coded(windows)
        runs.append(Run(common.tolist(), rest, span))
        docs.append(d.tolist())
        starts.append(t.tolist())
    return rows + recurring(runs, docs, starts, parts)


def words_of(windows: np.ndarray) -> list[np.ndarray]:
    """Windows as 64-bit words that compare as their bytes do, the first word first."""
    width = -(-windows.shape[1] // 8) * 8
    wide = np.zeros((len(windows), width), np.uint8)
    wide[:, :windows.shape[1]] = windows
    return list(wide.view(">u8").astype(np.uint64).T)


def order_windows(windows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of the windows in ascending order, those of smaller documents first."""
    return np.lexsort((owner, *words_of(windows)[::-1]))


def merge_runs(blobs: list[bytes], span: int, parts: int) -> list[tuple]:
    """The runs of hot windows of a destination (pass 4)."""
    runs, docs, starts = [], [], []
    for blob in blobs:
        common, rest, (doc, start) = decoded_run(blob, "<i8", "<u4")
        runs.append(Run(common, rest, span))
        docs.append(doc.tolist())
        starts.append(start.tolist())
    return recurring(runs, docs, starts, parts)


def recurring(runs: list[Run], docs: list[list[int]], starts: list[list[int]], parts: int
              ) -> list[tuple]:
    """Merge runs: of equal windows all but the smallest document's go."""
    gone_docs, gone_starts, group = [], [], []

    def close() -> None:
        least = min(d for d, _ in group)
        for d, s in group:
            if d > least:
                gone_docs.append(d)
                gone_starts.append(s)

    for run, place, common in merged(runs):
        if common < runs[run].span:
            if len(group) > 1:
                close()
            group.clear()
        group.append((docs[run][place], starts[run][place]))
    if len(group) > 1:
        close()
    doc = np.array(gone_docs, "<i8")
    return list(by_part(GONE, block_of(doc, parts), [
        doc, np.array(gone_starts, "<u4"), np.ones(len(doc), "<u4")]))


def packed_texts(rows: DataFrame, parts: int) -> DataFrame:
    """Rows (id, tag, text) by blocks of documents: (part, blob)."""

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids, tags = batch["id"].to_numpy(np.int64), batch["tag"].to_numpy(np.int64)
            raw = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            part, out = block_of(ids, parts), []
            order = np.argsort(part, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                sizes = np.array([len(raw[i]) for i in mine], "<i8")
                out.append((0, int(part[mine[0]]), zstandard.ZstdCompressor(level=1).compress(
                    b"".join([len(mine).to_bytes(8, "little"), ids[mine].tobytes(),
                              tags[mine].tobytes(), sizes.tobytes(),
                              *[raw[i] for i in mine]]))))
            yield frame(out)

    return rows.mapInPandas(bundle, PACKED)


def texts_of(blob: bytes) -> Iterator[tuple[int, int, bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[:8], "little")
    ids, tags, sizes = np.frombuffer(data, "<i8", 3 * n, 8).reshape(3, n)
    at = 8 + 24 * n
    for doc, tag, size in zip(ids.tolist(), tags.tolist(), sizes.tolist(), strict=True):
        yield doc, tag, data[at:at + size]
        at += size


def uncovered(raw: bytes, marks: list[tuple[np.ndarray, np.ndarray]], span: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """First and end places of the maximal runs of bytes under marked windows."""
    if not marks or not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.concatenate([m[0] for m in marks]).astype(np.int64)
    end = first + np.concatenate([m[1] for m in marks]).astype(np.int64) + span - 1
    turn = np.zeros(len(raw) + 1, np.int64)
    np.add.at(turn, np.minimum(first, len(raw)), 1)
    np.add.at(turn, np.minimum(end, len(raw)), -1)
    edge = np.diff(np.concatenate([[0], np.cumsum(turn[:-1]) > 0, [0]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


RESULT = ("id bigint, tag bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
          "kept_sha256 string, kept binary")


def removals(rows: DataFrame, span: int, k: int, with_text: bool) -> DataFrame:
    """(RESULT) of rows (id, tag, text). `kept` is null unless asked for."""
    if not 1 <= k <= span:
        raise ValueError("the k-gram must fit the window")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))

    def first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["id"].to_numpy(np.int64)
            for begin, texts in portions(batch["text"].tolist(), TOGETHER):
                yield of_batch(ids[begin:begin + len(texts)], [
                    t.encode("utf-8", "surrogatepass") for t in texts], span, k, parts)

    def second_pass(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return meet(group["blob"].tolist(), span, k, parts) if key[0] == RECORD else group

    def third_pass(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        if not len(texts) or not len(marks):
            return frame([])
        asked = {int(d) for b in marks["blob"] for d in np.unique(unpack(b, *MARK)[0])}
        found = {d: raw for b in texts["blob"] for d, _, raw in texts_of(b) if d in asked}
        cold, hot = (marks["blob"][marks["kind"] == kind].tolist() for kind in (CONTESTED, HOT))
        return frame((chunk_runs(found, cold, span, k, parts) if cold else [])
                     + (sorted_runs(found, hot, span, parts) if hot else []))

    def fourth_pass(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] == CHUNKS:
            return frame(merge_chunks(group["blob"].tolist(), span, k, parts))
        return frame(merge_runs(group["blob"].tolist(), span, parts)) if key[0] == RUN else group

    def last_pass(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        by_doc: dict[int, list] = {}
        for blob in marks["blob"]:
            doc, start, count = unpack(blob, *MARK)
            order = np.argsort(doc, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
                by_doc.setdefault(int(doc[mine[0]]), []).append((start[mine], count[mine]))
        out = []
        for blob in texts["blob"]:
            for doc, tag, raw in texts_of(blob):
                first, end = uncovered(raw, by_doc.get(doc, []), span)
                rest = b"".join(raw[a:b] for a, b in zip([0, *end], [*first, len(raw)],
                                                         strict=True))
                out.append((doc, tag, len(raw), len(raw) - len(rest), len(first),
                            hashlib.sha256(rest).hexdigest(), rest if with_text else None))
        return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    sent = rows.select("id", "text").mapInPandas(first_pass, PACKED)
    met = kept(sent.groupBy("kind", "part").applyInPandas(second_pass, PACKED))
    del sent
    release(rows.sparkSession)
    runs = packed_texts(rows, parts).groupBy("part").cogroup(
        met.where(F.col("kind").isin(CONTESTED, HOT)).groupBy("part")).applyInPandas(third_pass, PACKED)
    last = kept(runs.groupBy("kind", "part").applyInPandas(fourth_pass, PACKED))
    del runs
    release(rows.sparkSession)
    gone = met.where(F.col("kind") == GONE).unionByName(last)
    return packed_texts(rows, parts).groupBy("part").cogroup(gone.groupBy("part")).applyInPandas(
        last_pass, RESULT)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    text = F.coalesce(F.col(text), F.lit(""))
    return in_small_batches(docs).select(F.coalesce(F.col(key).cast("bigint"), F.lit(LEAST)).alias("id"),
                       F.xxhash64(text).alias("tag"), text.alias("text"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN,
                   k: int = K, with_text: bool = False) -> DataFrame:
    """What is left of each text: (key, n_bytes, n_removed, n_spans, kept_sha256[, kept]).

    A byte goes if it is covered by `span` bytes that also start in a document with a smaller key,
    judged on the input. Texts are UTF-8 bytes, null is empty, and matches stay within a document. A
    null key is the smallest. Rows with one key are one document: they do not remove each other's
    bytes, equal ones are returned each, and should their texts differ, what goes at a place of one
    goes at that place of all. One row per row; none for an empty table. Other columns are not read.
    """
    found = removals(_rows(docs, key, text), span, k, with_text)
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
    return found.select(F.when(F.col("id") != LEAST, F.col("id")).alias(key), *columns)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    span: int = SPAN, k: int = K) -> DataFrame:
    """The documents with all their columns and shortened texts. Null texts stay null; a character
    of which only a part is left goes whole."""
    rows = _rows(docs, key, text)
    found = removals(rows, span, k, True).where("n_removed > 0").dropDuplicates(["id", "tag"]).select(
        F.col("id").alias("_id"), F.col("tag").alias("_tag"), F.col("kept").alias("_kept"))
    columns = [(F.coalesce(_decoded(F.col("_kept")), F.col(f"d.`{c}`")) if c == text
                else F.col(f"d.`{c}`")).alias(c) for c in docs.columns]
    same = (F.coalesce(F.col(f"d.`{key}`").cast("bigint"), F.lit(LEAST)) == F.col("_id")) & (
        F.xxhash64(F.coalesce(F.col(f"d.`{text}`"), F.lit(""))) == F.col("_tag"))
    return docs.alias("d").join(found, same, "left").select(*columns)


def _decoded(raw):
    @F.pandas_udf("string")
    def decode(blobs: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else bytes(b).decode("utf-8", "ignore")
                          for b in blobs], dtype=object)

    return decode(raw)
