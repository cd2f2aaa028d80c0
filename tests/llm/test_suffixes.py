import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logtables.llm import suffixes

from .cases import COLUMNS, edge_rows, edges, nothing, row


def brute(docs, span):
    """(bytes, removed, spans, digest) of each (id, text)."""
    least, out = {}, []
    for doc, text in docs:
        raw = text.encode()
        for i in range(len(raw) - span + 1):
            w = raw[i:i + span]
            least[w] = min(least.get(w, doc), doc)
    for doc, text in docs:
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - span + 1):
            if least[raw[i:i + span]] < doc:
                gone[i:i + span] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        rest = np.frombuffer(raw, np.uint8)[~gone].tobytes() if raw else b""
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


@pytest.fixture(autouse=True)
def many_parts(monkeypatch):
    monkeypatch.setattr(suffixes, "PART_BYTES", 2000)


def random_docs(seed, n, alphabet="ab c"):
    rng = random.Random(seed)
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    return [(i, "".join(rng.choice(parts) + rng.choice(["", "x", "é", str(i)])
                        for _ in range(rng.randint(0, 8)))) for i in rng.sample(range(1000), n)]


@pytest.mark.parametrize("seed, span, k", [(1, 50, 20), (2, 12, 4), (3, 9, 9), (4, 5, 1), (5, 16, 5)])
def test_against_all_windows(spark, seed, span, k):
    docs = random_docs(seed, 60)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = suffixes.remove_repeats(table, span=span, k=k)
    assert sorted(map(tuple, found.collect())) == brute(docs, span)


@pytest.mark.parametrize("same, meeting", [(8, 256), (3, 2), (500, 4)])
def test_a_passage_in_very_many_documents(spark, monkeypatch, same, meeting):
    """More surroundings than a task sends on, or than may meet; hot windows in all runs."""
    monkeypatch.setattr(suffixes, "SAME_GRAM", same)
    monkeypatch.setattr(suffixes, "MEETING", meeting)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    docs = [(i, f"{rng.random()} {passage} {rng.random()}" * (1 + i % 2)) for i in range(200)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    found = suffixes.remove_repeats(table)
    assert sorted(map(tuple, found.collect())) == brute(docs, 50)


RUNS = st.lists(st.lists(st.binary(min_size=4, max_size=4), min_size=1, max_size=12), min_size=1,
                max_size=9)


@settings(max_examples=200, deadline=None)
@given(RUNS)
def test_runs_are_merged_in_order(given_runs):
    runs, expected = [], sorted(w for run in given_runs for w in run)
    for run in given_runs:
        windows = np.frombuffer(b"".join(sorted(run)), np.uint8).reshape(-1, 4)
        common, rest = suffixes.front_coded(windows)
        runs.append(suffixes.Run(common.tolist(), rest, 4))
    texts = [sorted(run) for run in given_runs]
    found, shared = [], []
    for run, place, common in suffixes.merged(runs):
        found.append(texts[run][place])
        shared.append(common)
    assert found == expected
    for one, other, common in zip(found, found[1:], shared[1:]):
        same = next((i for i in range(4) if one[i] != other[i]), 4)
        assert common == same


def test_packing_keeps_arrays():
    a, b = np.arange(300, dtype="<i8") ** 2, np.arange(300).astype("u1")
    back = suffixes.unpack(suffixes.pack(a, b), "<i8", "u1")
    assert (back[0] == a).all() and (back[1] == b).all()
    assert [len(x) for x in suffixes.unpack(suffixes.pack(a[:0], b[:0]), "<i8", "u1")] == [0, 0]


def test_edges(spark):
    found = suffixes.remove_repeats(edges(spark), with_text=True).collect()
    assert len(found) == len(edge_rows())
    by_id = {r.doc_id: r for r in found if r.doc_id not in (2, 12)}
    assert by_id[3].n_bytes == by_id[4].n_bytes == 0
    assert by_id[11].n_removed == 0 and by_id[8].n_removed > 50_000
    assert all(r.n_removed > 50 for r in found if r.doc_id == 12 and r.n_bytes < 130)
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in found)
    assert suffixes.remove_repeats(nothing(spark)).count() == 0


def test_texts_are_cut_at_characters(spark):
    tail = "é" * 40
    docs = spark.createDataFrame([row(1, "a" + tail), row(2, "bé" + tail), row(3, None)], COLUMNS)
    found = suffixes.without_repeats(docs)
    assert found.columns == docs.columns
    assert {r.doc_id: r.text for r in found.collect()} == {1: "a" + tail, 2: "b", 3: None}
