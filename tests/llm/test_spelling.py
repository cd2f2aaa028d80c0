import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logtables.llm import spelling

from .cases import edges, nothing


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:j] + b[j + 1:] == a for j in range(len(b)))


def brute(rows, least=7):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
            if len(low) >= least:
                n[low] += 1
    words = {w: c for w, c in n.items() if c >= 2}
    form, out = {}, []
    number = {}
    for w in words:
        found = [v for v in words if near(w, v)]
        number[w] = len(found)
        if found:
            best = min(found, key=lambda v: (-words[v], v))
            if words[best] >= 10 * words[w]:
                form[w] = best
    for w, c in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, c, number[w], words.get(form.get(w))))
    return sorted(out)


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    df = spelling.variants(docs)
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def edit(rng, word, letters):
    at = rng.randrange(len(word) + 1)
    return word[:at] + rng.choice(["", rng.choice(letters)]) + word[at + rng.randrange(2):]


def test_equal_to_all_pairs(spark):
    """Few letters, so runs of equal ones, ties and chains abound; accents, capitals, repeated rows."""
    rng = random.Random(11)
    letters = "aabéÿ"
    base = ["".join(rng.choices(letters, k=rng.randrange(6, 11))) for _ in range(60)]
    pool = base + [edit(rng, w, letters) for w in base for _ in range(4)]
    pool = [w for w in pool if w]
    weights = [1 / (1 + i % 60) ** 2 for i in range(len(pool))]
    rows = []
    for i in range(160):
        words = rng.choices(pool, weights, k=120)
        words = [w.upper() if rng.random() < 0.1 else w for w in words]
        rows.append((i, "".join(w + rng.choice([" ", "-", "9", "× ", ", "]) for w in words)))
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, None), (7, ""), (8, "\n")]
    expected = brute(rows)
    chains = [r for r in expected if r[1] is not None and r[2] != r[1]]
    assert len(expected) > 200 and chains
    assert found(spark, rows) == expected


def test_long_words(spark):
    """Around the length from which prefixes are fingerprints, and far above it, with edits at both
    ends, in the middle and in runs."""
    rng = random.Random(3)
    rows, words = [], []
    for size in (63, 64, 65, 66, 700):
        word = "".join(rng.choices("abcdefgé", k=size - 2)) + "gg"
        some = [word, word[:-1], "x" + word, word[:30] + "z" + word[31:], word[1:], word + "g",
                word[:30] + word[31:], "y" + word[1:]]
        words += some
        for k, w in enumerate(some):
            rows += [(100 * size + k * 10 + j, w) for j in range(25 if k == 0 else 2)]
    expected = brute(rows)
    assert len(expected) >= 30 and sum(r[4] for r in expected) > 60
    assert found(spark, rows) == expected


def test_an_unbroken_run_of_letters(spark):
    """A hundred thousand letters; a copy, and one with a letter replaced."""
    rng = random.Random(4)
    word = "".join(rng.choices("abcdefgh", k=100_000))
    other = word[:777] + "z" + word[778:]
    rows = []
    ids = iter(range(10**6))
    for w, times in ((word, 20), (other, 2)):
        while times:
            i = next(ids)
            if zlib.crc32(f"{i}:{w}".encode()) % 31:
                rows.append((i, w))
                times -= 1
    assert found(spark, rows) == sorted([(word, None, word, 20, 1, None),
                                         (other, word, word, 2, 1, 20)])


@settings(max_examples=100, deadline=None)
@given(st.text("abc", min_size=1, max_size=12))
def test_fingerprints_are_of_the_rotations(word):
    marked = word + "$"
    points = np.frombuffer(marked.encode("utf-32-le"), "<u4").astype(np.int64)
    whole, edited = spelling.fingerprints(points)

    def of(text):
        return [sum(ord(c) * pow(b, i, p) for i, c in enumerate(text)) % p
                for p, b in zip(spelling.PRIMES, spelling.BASES)]

    for i in range(len(marked)):
        assert whole[i].tolist() == of(marked[i:] + marked[:i])
    for i in range(len(word)):
        assert edited[i].tolist() == of(marked[i + 1:] + marked[:i])


def test_ranges_are_bounded_by_the_letters(spark):
    """One word with every variant there is: no prefix has more members than letters and one."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xE0, 0x100)]]
    words = ["abcdefgh"] + [f"abc{c}efgh" for c in letters if c != "d"]
    df = spark.createDataFrame([(w, 2, i) for i, w in enumerate(words)],
                               "word string, n bigint, pref bigint")
    sizes = spelling.rotations(df).groupBy("prefix").count()
    assert sizes.agg({"count": "max"}).first()[0] <= len(letters) + 1
    near_all = {r.pref: r.n_near for r in spelling.neighbours(df).collect()}
    assert set(near_all.values()) == {len(words) - 1}


def test_edges(spark):
    docs = edges(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, spelling.variants(docs).collect())) == brute(rows)
    assert spelling.variants(nothing(spark)).count() == 0


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "ab " * 100_000])
def test_texts_of_one_kind(spark, text):
    rows = [(i, text) for i in range(4)]
    assert [(r[3], r[4]) for r in found(spark, rows)] in ([], [(4, 0)], [(3, 0)], [(2, 0), (2, 0)])
