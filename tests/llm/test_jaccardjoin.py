import random
import re

import numpy as np
import pytest

from logtables.llm import components, jaccardjoin

from .cases import edge_rows, edges, nothing


def shingle_set(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def brute(rows):
    sets = [shingle_set(text) for _, text in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r, k = root(i), (key is not None, key or 0)
        least[r] = min(least.get(r, k), k)
    return sorted(((key, len(sets[i]), least[root(i)][1] if least[root(i)][0] else None)
                   for i, (key, _) in enumerate(rows)), key=repr)


def joined(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = jaccardjoin.jaccard_classes(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, found.collect()), key=repr)


def groups(rng):
    """Chains of near copies about the limit, exact and reordered copies, a passage in many documents,
    short texts, words used everywhere."""
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    rows = []

    def text(n):
        return rng.choices(vocabulary, [1 / (i + 1) for i in range(400)], k=n)

    for _ in range(25):
        words = text(rng.choice([1, 2, 3, 4, 9, 20, 40, 70, 150, 400]))
        for _ in range(rng.choice([1, 2, 3, 12])):
            rows.append(" ".join(words))
            words = list(words)
            for _ in range(rng.choice([0, 1, 1, 2])):
                at = rng.randrange(len(words))
                words[at:at + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2)) or ["x"]
    for _ in range(20):
        rows.append(" ".join(text(20) + passage + text(20)))
    rows += rows[:4] + ["", " \n", "one", "one", "ONE", "one two", "é É", "a b a b a b a b", "a b c d"]
    rng.shuffle(rows)
    return [(3 * i % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, small, block, sampled", [(1, 32, 192, 4), (2, 1, 3, 4), (3, 4, 5, 1),
                                                         (4, 2, 2, 10**9)])
def test_equal_to_all_pairs(spark, monkeypatch, seed, small, block, sampled):
    for name, value in (("SMALL", small), ("BLOCK", block), ("SAMPLED", sampled)):
        monkeypatch.setattr(jaccardjoin, name, value)
    rows = groups(random.Random(seed))
    expected = brute(rows)
    assert len({r[2] for r in expected}) < len(expected) - 20
    assert joined(spark, rows) == expected


def test_a_large_group_of_near_copies(spark):
    """Three hundred copies, each with its own edit, in the same buckets."""
    rng = random.Random(9)
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(1 + i % 3):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    assert joined(spark, rows) == brute(rows)


def test_a_component_does_not_meet_itself(spark, monkeypatch):
    """Blocks of a bucket's largest component meet those of others only; all other pairs do meet."""
    monkeypatch.setattr(jaccardjoin, "BLOCK", 5)
    own = spark.range(100).selectExpr("1L AS bucket", "id", "if(id < 93, 0L, id) AS label")
    large = spark.sql("SELECT 1L AS bucket, 0L AS main, 93L AS held, 100L AS n")
    met = jaccardjoin.met_blocks(own, large).collect()
    # Two blocks of others, nineteen of the largest component.
    assert len(met) == 93 * 2 + 7 * 21
    blocks = {}
    for r in met:
        blocks.setdefault((r.one, r.two), []).append(r)
    assert all(min(r.mine for r in b) < 2 for b in blocks.values())
    seen = [(x.id, y.id) for met_ in blocks.values() for x in met_ for y in met_
            if x.id < y.id and (x.one == x.two or x.mine != y.mine)]
    assert len(seen) == len(set(seen))
    assert {p for p in seen if p[1] >= 93} == {(i, j) for j in range(93, 100) for i in range(j)}


def test_many_links_between_components_are_one_edge(spark, monkeypatch):
    plans, real = [], components.kept

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df)

    monkeypatch.setattr(components, "kept", seen)
    labels = spark.range(40).selectExpr("id", "id % 4 AS label")
    links = labels.alias("x").crossJoin(labels.alias("y")).where(
        "x.label < 2 AND y.label < 2").selectExpr("x.id AS a", "y.id AS b")
    found = components.connected(labels, links)
    assert {(r.id, r.label) for r in found.collect()} == {
        (i, 0 if i % 4 < 2 else i % 4) for i in range(40)}
    # Made one before they are turned both ways.
    assert plans[0].index("Generate") < plans[0].index("Aggregate")


def test_prefixes_meet_in_every_order():
    """Whatever the order, sets that agree share a token of their prefixes."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 9, 10, 11, 19, 20, 21, 100, 333):
        for _ in range(40):
            one = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            other = one.copy()
            for _ in range(rng.integers(0, max(1, n // 9) + 1)):
                other[rng.integers(0, n)] = rng.integers(0, 2**63)
            other = np.unique(other)
            both = len(np.intersect1d(one, other))
            if 100 * both < 90 * (len(one) + len(other) - both):
                continue
            a, b = jaccardjoin.listed(one, 90), jaccardjoin.listed(other, 90)
            assert all(set(x.tolist()) & set(y.tolist()) for x, y in zip(a[2], b[2]))


def test_marks_rule_out_no_pair_that_agrees():
    """Of any sizes and shares; what they rule out differs in more tokens than it may."""
    rng = np.random.default_rng(6)
    passed = {}
    for n in (1, 2, 9, 10, 19, 20, 125, 130, 148, 400, 1100, 20_000):
        for share in (1, 0.95, 0.91, 0.9, 0.8, 0.6, 0):
            for percent in (90, 50):
                one = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
                other = np.unique(np.concatenate([one[:round(n * share)], rng.integers(
                    0, 2**63, rng.integers(0, 2) * (n - round(n * share)), dtype=np.uint64)]))
                if not len(other):
                    continue
                both, sizes = len(np.intersect1d(one, other)), np.array([len(one), len(other)])
                may = jaccardjoin.may_agree([jaccardjoin.marked(x) for x in (one, other)], sizes,
                                            np.array([0, 1]), np.array([1, 0]), percent)
                assert may[0] == may[1]
                assert may[0] or 100 * both < percent * (sizes.sum() - both)
                passed.setdefault((share, percent), []).append(bool(may[0]))
    assert sum(passed[0.6, 90]) <= 2 and sum(passed[0, 90]) == 0
    # No more bytes than tokens from 64 tokens on.
    assert all(len(jaccardjoin.marked(np.arange(n, dtype=np.uint64))) <= n for n in (64, 400, 9000))


def test_a_large_bucket_of_sets_that_stay_apart(spark, monkeypatch):
    """Blocks move marks only, some rows for each set; sets are read for pairs that these let pass."""
    own = spark.range(2313).selectExpr("1L AS bucket", "id", "if(id < 507, 0L, id) AS label")
    large = spark.sql("SELECT 1L AS bucket, 0L AS main, 507L AS held, 2313L AS n")
    assert jaccardjoin.met_blocks(own, large).count() <= 3 * 2313
    read, real = [], jaccardjoin.linked

    def seen(pairs, tokens, percent):
        read.append(pairs.count())
        return real(pairs, tokens, percent)

    monkeypatch.setattr(jaccardjoin, "linked", seen)
    rng = random.Random(4)
    base = [f"v{i}" for i in range(150)]
    rows = []
    for i in range(200):
        words = list(base)
        # Nearly all have a share of 0.6 to 0.85 with each other.
        for at in rng.sample(range(150), 2 + i % 5):
            words[at] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert joined(spark, rows) == brute(rows)
    assert sum(read) < 3 * len(rows)


def test_rows_that_are_not_listed_do_not_move(spark):
    rows = spark.range(20_000).selectExpr("id", "id * 7 AS tag")
    chosen = rows.where("id % 50 = 3")
    found = {r.id for r in jaccardjoin.maybe_listed(rows, chosen, ["id", "tag"]).collect()}
    assert {*range(3, 20_000, 50)} <= found and len(found) < 420
    assert jaccardjoin.maybe_listed(rows, chosen.limit(0), ["id", "tag"]).count() == 0


def test_words_do_not_depend_on_stretches(monkeypatch):
    texts = ["a b c d" * 9, "", "x" * 5000 + " y z", "\t\n", "é   ü" * 40]
    whole = jaccardjoin.token_sets(texts)
    monkeypatch.setattr(jaccardjoin, "STRETCH", 3)
    parts = jaccardjoin.token_sets(texts)
    assert [len(s) for s in whole] == [len(shingle_set(t)) for t in texts]
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    monkeypatch.setattr(jaccardjoin, "STRETCH", 1 << 20)
    assert all((jaccardjoin.token_sets([t])[0] == s).all() for t, s in zip(texts, whole))


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    found = jaccardjoin.jaccard_classes(edges(spark))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)
    assert jaccardjoin.jaccard_classes(nothing(spark)).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(2)
    words = [f"{rng.randrange(10**7)}" for _ in range(300_000)]
    other = list(words)
    for at in range(0, 300_000, 100):
        other[at] = "edit"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, "z" * 3_000_000), (4, " " * 1_000_000)]
    assert joined(spark, rows) == brute(rows)
