import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logtables.llm import components, orderhash

from .cases import edge_rows, edges, nothing


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


TOKENS = st.lists(st.integers(0, 6), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TOKENS, st.lists(st.tuples(st.integers(0, 40), st.integers(0, 6), st.booleans()), max_size=6),
       st.sampled_from([0.5, 0.8, 0.95, 1.0]))
def test_alignment_is_exact(base, edits, similarity):
    other = list(base)
    for at, token, insert in edits:
        other[at:at + (not insert)] = [token]
    m = common(base, other)
    total = len(base) + len(other)
    expected = not total or m >= similarity * (total - m) - 1e-9
    found = orderhash.aligned(np.array(base, np.uint64), np.array(other, np.uint64), similarity)
    assert found == expected


def test_words_and_shingles_do_not_depend_on_the_batch():
    texts = ["One two, THREE four five six", "", "été déjà vu", "one two three four five six!"]
    words, places = orderhash.word_hashes(texts)
    for i, text in enumerate(texts):
        alone, _ = orderhash.word_hashes([text])
        assert alone.tolist() == words[places[i]:places[i + 1]].tolist()
    assert np.diff(places).tolist() == [6, 0, 3, 6]
    assert words[:6].tolist() == words[9:].tolist()
    found, at = orderhash.shingles(words, places)
    assert np.diff(at).tolist() == [2, 0, 1, 2] and len(set(words.tolist())) == 9


def test_minima_are_listed_in_text_order():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 3, 4, 5, 200, 7000]
    places = np.concatenate([[0], np.cumsum(sizes)])
    labelled = rng.integers(0, 2**63, places[-1]).astype(np.uint64)
    found = orderhash.order_sketches(labelled, places, repeats=4, minima=4)
    for i, (a, b) in enumerate(zip(places[:-1], places[1:])):
        for r in range(4 if a < b else 0):
            with np.errstate(over="ignore"):
                value = orderhash.mixed(labelled[a:b] + np.uint64(r + 1) * orderhash.BASE)
            sketch = np.full(1, r + 1, np.uint64)
            for at in sorted(np.argsort(value)[:4]):
                with np.errstate(over="ignore"):
                    sketch = orderhash.mixed(sketch * orderhash.BASE + labelled[a + at])
            assert found[i, r] == sketch[0]


def test_order_matters_and_repeats_count():
    a = "a b c d e f g h i j k l m n o p".split()
    swapped = a[8:] + a[:8]
    def sketch(words):
        found, at = orderhash.shingles(*orderhash.word_hashes([" ".join(words)]))
        return orderhash.order_sketches(orderhash.with_occurrence(found, at), at)[0]
    assert (sketch(a) == sketch(a)).all() and (sketch(a) != sketch(swapped)).any()
    twice, at = orderhash.shingles(*orderhash.word_hashes(["x " * 9]))
    assert len(set(twice.tolist())) == 1
    assert len(set(orderhash.with_occurrence(twice, at).tolist())) == 5


def classes(docs):
    """Components of aligned similarity 0.8 and more, by comparing all pairs."""
    import re
    words = [re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower()) for _, t in docs]
    shingle = [[tuple(w[i:i + 5]) for i in range(max(min(1, len(w)), len(w) - 4))] for w in words]
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            total = len(shingle[i]) + len(shingle[j])
            overlap = sum((Counter(shingle[i]) & Counter(shingle[j])).values())
            if total and overlap < 0.8 * (total - overlap) - 1e-9:
                continue
            m = common(shingle[i], shingle[j])
            if m >= 0.8 * (total - m) - 1e-9:
                parent[top(i)] = top(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        least[top(i)].append(doc)
    return sorted((doc, min(least[top(i)])) for i, (doc, _) in enumerate(docs))


def test_groups_of_near_copies(spark):
    """A large group made from one text, pairs, chains, and texts that only share a passage."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    def edited(words, edits):
        words = list(words)
        for _ in range(edits):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        return words

    base, chain, passage = text(200), text(150), text(40)
    docs = [edited(base, 3) for _ in range(40)] + [base] * 3
    for _ in range(6):
        docs.append(chain)
        chain = edited(chain, 2)
    docs += [text(60) + passage + text(60) for _ in range(20)] + [text(80) for _ in range(20)]
    rows = [(i * 7 % 101, " ".join(w)) for i, w in enumerate(docs)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = sorted((r.doc_id, r.class_id) for r in orderhash.near_copies(table).collect())
    assert found == classes(rows)


@pytest.mark.parametrize("small, block", [(1, 4), (1, 1000), (3, 7)])
def test_blocks_lose_no_link(spark, monkeypatch, small, block):
    """Copies just within and just beyond the similarity, in buckets compared by blocks."""
    monkeypatch.setattr(orderhash, "SMALL", small)
    monkeypatch.setattr(orderhash, "BLOCK", block)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(160)]
    rows = []
    for i in range(50):
        words = list(base)
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = sorted((r.doc_id, r.class_id) for r in orderhash.near_copies(table).collect())
    assert found == classes(rows)


def test_short_texts_always_meet(spark):
    """Texts of 8 to 40 words and the same with one word more at an end: 4 against 5 shingles is 0.8."""
    rng = random.Random(11)
    rows = []
    for n in [8] * 60 + [9] * 60 + list(range(5, 41)) * 2:
        words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        more = f"w{rng.randrange(10**9)}"
        for text in (words, [more, *words] if rng.random() < 0.5 else [*words, more]):
            rows.append((len(rows), " ".join(text)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = sorted((r.doc_id, r.class_id) for r in orderhash.near_copies(table).collect())
    assert found == classes(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=20), st.integers(0, 3), st.randoms(),
       st.sampled_from([0.5, 0.8, 1.0]))
def test_first_shingles_miss_no_near_text(base, edits, rng, similarity):
    other = list(base)
    for _ in range(edits):
        at = rng.randrange(len(other) + 1)
        other[at:at + rng.randrange(2)] = [rng.randrange(12)]
    sides = [np.array(x, np.uint64) for x in (base, other)]
    if min(len(base), len(other)) <= orderhash.FEW and orderhash.aligned(*sides, similarity):
        names = [orderhash.bucket_names(orderhash.with_occurrence(x, np.array([0, len(x)])),
                                        np.array([0, len(x)]), similarity)[0] for x in sides]
        assert np.isin(*names).any()


def test_recall_of_the_sketches():
    """The probability by the formula, for texts with over FEW shingles that agree to 0.8."""
    from math import comb
    for union in range(orderhash.FEW + 1, 2000):
        shared = -(-4 * union // 5)
        p = comb(shared, orderhash.MINIMA) / comb(union, orderhash.MINIMA)
        assert 1 - (1 - p) ** orderhash.REPEATS > 0.9999


def test_overlaps_are_counted(monkeypatch):
    monkeypatch.setattr(orderhash, "COLUMNS", 3)
    rng = np.random.default_rng(1)
    sets = [rng.choice(40, n, replace=False).astype(np.uint64) for n in (0, 1, 5, 12, 30, 40)]
    found = orderhash.overlaps(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert found[i, j] == len(set(a.tolist()) & set(b.tolist()))


def test_edges(spark):
    found = orderhash.near_copies(edges(spark)).collect()
    assert len(found) == len(edge_rows())
    of = {r.doc_id: r.class_id for r in found if r.doc_id not in (None, 12)}
    assert of[2] == of[1] == 1 and of[10] == of[9] == 9 and of[8] == of[7] == 7
    assert of[3] is None and of[4] is None and of[11] == 11  # with the empty text without an id
    assert sum(r.kept for r in found) == len({
        (r.class_id, r.text_hash) for r in found if r.kept})
    assert orderhash.near_copies(nothing(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 40)] + [(50, rng.randrange(51, 90)) for _ in range(60)]
    links += [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    parent = {i: i for i in range(200)}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    labels = spark.range(200).selectExpr("id", "id AS label")
    half = components.connected(labels, spark.createDataFrame(links[::2], "a bigint, b bigint"))
    found = components.connected(half, spark.createDataFrame(links[1::2], "a bigint, b bigint"))
    assert {r.id: r.label for r in found.collect()} == {i: top(i) for i in range(200)}


@given(st.lists(st.integers(0, 3), max_size=24), st.lists(st.integers(0, 3), max_size=24),
       st.integers(0, 25))
def test_the_band_slides(one, other, band):
    best = [0] * (len(other) + 1)
    for i, x in enumerate(one):
        row = [0]
        for j, y in enumerate(other):
            hit = best[j] + 1 if x == y and abs(i - j) <= band else 0
            row.append(max(best[j + 1], row[j], hit))
        best = row
    assert orderhash._matches(one, other, band) == best[-1]


def test_long_pairs_need_memory_in_proportion():
    """Two texts of 200,000 words, one in twelve changed: a bit table of all places would be 2.5 GB."""
    words = np.arange(200_000, dtype=np.uint64)
    other = words.copy()
    other[::12] += np.uint64(1 << 40)
    tracemalloc.start()
    try:
        assert orderhash.aligned(words, other)
        assert tracemalloc.get_traced_memory()[1] < 100_000_000
    finally:
        tracemalloc.stop()
