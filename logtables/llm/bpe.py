"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for others."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.shared import in_small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens whose ids a worker remembers; beyond that it starts anew. Results do not depend on it.
REMEMBERED = 500_000
#: Keys per bucket of the perfect hash, on average.
PER_BUCKET = 2.5


STEP, SCATTER = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
WORD = (1 << 64) - 1


class PerfectHash:
    """Maps n distinct byte strings to 0 ... n - 1, by hash and displacement.

    Keys fall into small buckets; each bucket has one number that, mixed into the hashes of its
    keys, sends them to free slots. The largest buckets choose first; the single keys of the last
    ones are sent straight to the slots left over. A string that is not a key lands on some slot
    too, so the key kept there is compared.
    """

    def __init__(self, keys: list[bytes]):
        n = self.size = len(keys)
        self.buckets = max(1, int(n / PER_BUCKET))
        found = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(found)) != n:
            raise ValueError("keys must be distinct")
        own = (found % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(own, kind="stable")
        edges = np.searchsorted(own[order], np.arange(self.buckets + 1))
        free, tries = np.ones(n, bool), np.arange(256, dtype=np.uint64)
        shift, slots, gaps = [0] * self.buckets, np.empty(n, np.int64), None
        for b in np.argsort(edges[:-1] - edges[1:], kind="stable"):
            members = order[edges[b]:edges[b + 1]]
            if len(members) > 1:
                begin, at = 0, None
                while at is None:
                    at = self._free_slots(found[members], tries + np.uint64(begin), free)
                    begin += len(tries)
                shift[b], slots[members] = begin - len(tries) + at[0], at[1]
                free[at[1]] = False
            elif len(members):
                gaps = iter(np.flatnonzero(free).tolist()) if gaps is None else gaps
                slots[members] = slot = next(gaps)
                shift[b] = -1 - slot
        self.shift = shift
        self.keys: list[bytes] = [b""] * n
        for key, slot in zip(keys, slots.tolist(), strict=True):
            self.keys[slot] = key

    def _free_slots(self, found, shifts, free):
        """The first of the shifts that sends all of a bucket's keys to different free slots."""
        with np.errstate(over="ignore"):
            mixed = found + shifts[:, None] * np.uint64(STEP)
            mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(SCATTER) >> np.uint64(32)
        at = (mixed % np.uint64(self.size)).astype(np.int64)
        ordered = np.sort(at, axis=1)
        good = free[at].all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
        first = int(good.argmax())
        return (first, at[first]) if good[first] else None

    def find(self, key: bytes) -> int:
        """The slot of a key; -1 if it is none."""
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        if shift < 0:
            slot = -1 - shift
        else:
            h = h + shift * STEP & WORD
            slot = ((h ^ h >> 32) * SCATTER & WORD) >> 32
            slot %= self.size
        return slot if self.keys[slot] == key else -1


class Encoder:
    """Ids of pre-tokens by the ranks of a vocabulary file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.whole = PerfectHash(list(ranks))
        self.ids = [self.ranks[key] for key in self.whole.keys]
        self.tokens = dict(zip(ranks.values(), ranks, strict=True))

    def encode(self, piece: bytes) -> list[int]:
        slot = self.whole.find(piece)
        return [self.ids[slot]] if slot >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Join neighbours of the lowest rank, leftmost first, until none is in the vocabulary.

        Parts are linked by the place of their next part; a heap has candidate pairs. An entry
        counts only while its pair is still the one that starts there.
        """
        ranks, n = self.ranks, len(piece)
        following = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n - 1))
        current = [ranks.get(piece[i:i + 2], -1) if i + 1 < n else -1 for i in range(n)]
        heap = [(rank, i) for i, rank in enumerate(current) if rank >= 0]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if current[i] != rank:
                continue
            middle = following[i]
            end = following[i] = following[middle]
            current[middle] = -1
            if end < n:
                before[end] = i
                current[i] = ranks.get(piece[i:following[end]], -1)
                if current[i] >= 0:
                    heapq.heappush(heap, (current[i], i))
            else:
                current[i] = -1
            if i:
                j = before[i]
                current[j] = ranks.get(piece[j:end], -1)
                if current[j] >= 0:
                    heapq.heappush(heap, (current[j], j))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:following[i]]])
            i = following[i]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Remembered(dict):
    """Packed ids (little-endian unsigned 32-bit) by pre-token, worked out when first asked for."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = np.array(self.encoder.encode(piece.encode("utf-8", "surrogatepass")), "<u4")
        self[piece] = packed = ids.tobytes()
        return packed


@cache
def loaded(path: str) -> Remembered:
    """The encoder of a rank file, made once per worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Remembered(Encoder(ranks))


def packed_ids(text: str, memory: Remembered, pattern: regex.Pattern) -> bytes:
    return b"".join(map(memory.__getitem__, pattern.findall(text)))


ROUND_TRIP = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_text(docs: DataFrame, text: str = "text", into: str = "ids",
                vocabulary: str = VOCABULARY) -> DataFrame:
    """Add the ids of each whole text as an array of bigint. Null text: no ids."""

    @F.pandas_udf("array<bigint>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory = loaded(public_tokenizers.path(vocabulary))
        pattern = regex.compile(public_tokenizers.PATTERN)
        for texts in batches:
            yield pd.Series([np.frombuffer(packed_ids(t, memory, pattern), "<u4").astype(np.int64)
                             for t in texts.fillna("")])

    return in_small_batches(docs).withColumn(into, encode(F.col(text)))


def decode_ids(docs: DataFrame, ids: str = "ids", into: str = "decoded",
               vocabulary: str = VOCABULARY) -> DataFrame:
    """Add the bytes of each array of ids. Null: no bytes. An unknown id fails the job."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = loaded(public_tokenizers.path(vocabulary)).encoder
        for arrays in batches:
            yield pd.Series([b"" if a is None else encoder.decode(a.tolist()) for a in arrays])

    return docs.withColumn(into, decode(F.col(ids)))


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text",
               vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode each whole text and decode its ids: (key, n_tokens, ids_sha256, decoded_sha256).

    Null text is empty: no ids, the digest of no bytes. One row per row, whatever the key; no rows
    for an empty table. Other columns are not read. No shuffle: texts go through one function, by
    batches; a worker keeps the vocabulary and the pre-tokens it has met last.
    """

    @F.pandas_udf(ROUND_TRIP)
    def trip(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory = loaded(public_tokenizers.path(vocabulary))
        pattern = regex.compile(public_tokenizers.PATTERN)
        decode = memory.encoder.decode
        for texts in batches:
            rows = []
            for body in texts.fillna(""):
                ids = packed_ids(body, memory, pattern)
                decoded = decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(decoded).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return in_small_batches(docs).select(F.col(key), trip(F.col(text)).alias("_found")).select(key, "_found.*")
