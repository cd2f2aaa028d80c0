import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logtables.llm import packing

from .cases import edge_rows, edges, nothing

COUNTS = st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=25)


def filled(plan):
    """Every bin's lengths, with the ranks that land there."""
    bins, base = defaultdict(list), 0
    for count, _, content in plan.blocks:
        for length, first, each in content:
            for i in range(count * each):
                bins[base + i // each].append((length, first + i))
        base += count
    return bins


@settings(max_examples=200, deadline=None)
@given(COUNTS, st.integers(1, 8))
def test_a_plan_places_every_piece_once(counts, groups):
    plan = packing.plan_bins(counts, capacity=64, groups=groups)
    bins = filled(plan)
    assert all(sum(n for n, _ in b) <= 64 and b for b in bins.values())
    placed = Counter(x for b in bins.values() for x in b)
    assert placed == Counter((n, r) for n, c in counts.items() for r in range(c))


def best_fit_decreasing(counts, capacity):
    free = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [(f, i) for i, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits)[1]] -= n
        else:
            free.append(capacity - n)
    return len(free)


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_close_to_the_bound(seed):
    rng = random.Random(seed)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(3000))
    bins = len(filled(packing.plan_bins(counts)))
    bound = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert bins <= bound * 1.01 + 2
    assert bins <= best_fit_decreasing(counts, 2048) + 2


def test_lengths_beyond_the_capacity_are_refused():
    with pytest.raises(ValueError):
        packing.plan_bins({65: 1}, capacity=64)


def test_the_rank_file_gives_the_ids_of_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    other, own = Tokenizer.from_file(path), packing.encoder()
    for *_, text in [(r[1],) for r in edge_rows() if r[1]]:
        assert own.encode_ordinary(text) == other.encode(text, add_special_tokens=False).ids
    assert base64  # the rank file's format


def test_pack(spark):
    docs = edges(spark)
    found = packing.pack(docs).collect()
    assert [c for c in packing.pack(docs).columns] == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    encode = packing.encoder().encode_ordinary
    expected = Counter()
    for doc_id, text, *_ in edge_rows():
        ids = np.array([*encode(text or ""), 0], "<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048


def test_nothing_to_pack(spark):
    assert packing.pack(nothing(spark)).count() == 0


def test_added_tokens_have_their_ids(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"code  {end}\n\n  x", f"  {end[:-1]} {end}>", f"é{end}\t",
             f"word \n {end} " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {(r.doc_id, r.piece): r for r in packing.pieces(docs, capacity=64).collect()}
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert 50256 in ids
        own = sorted((r.start, r.length, r.ids_crc32) for (doc, _), r in found.items() if doc == i)
        assert sum(n for _, n, _ in own) == len(ids)
        for start, n, crc in own:
            assert crc == zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())


@pytest.mark.parametrize("text", [
    " " * 1_000_000, "a" + "\n" * 1_000_000 + "b", "\t" * 1_000_000 + "x y", " \n" * 600_000])
def test_very_long_runs_of_blanks_are_encoded(text):
    whole = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert packing.Encoder().ids(text) == whole.encode(text, add_special_tokens=False).ids


def test_a_text_that_the_fast_encoder_cannot_take_is_packed(spark):
    rows = [(1, "word " * 50), (2, "x" + " " * 1_000_000), (3, None)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    length = {}
    for r in found:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    whole = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert length == {i: 1 + len(whole.encode(t or "", add_special_tokens=False).ids)
                      for i, t in rows}
