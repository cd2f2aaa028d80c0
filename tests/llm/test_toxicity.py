import pytest
from pyspark.sql import functions as F

from logtables.llm import langid, toxicity

from .cases import edges, nothing

WORDS = "the idiot and moron are stupid clown scum over there with some other plain words".split()


@pytest.fixture(scope="module")
def channel(spark):
    rows = [(i, " ".join(WORDS[i % 5:] + WORDS[:i % 5])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return toxicity.learn_channel(docs)


@pytest.mark.parametrize("written, read", [
    ("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("m0r0n", "moron"),
    ("$tup1d", "stupid"), ("s-c-u-m", "scum"), ("cl0wn", "clown"), ("plain", "plain"),
    ("other", "other")])
def test_readings(channel, written, read):
    assert toxicity.restored(written, channel) == read


def test_the_path_is_the_cheapest_of_all(channel):
    """Against every reading of the lattice, one by one."""
    def readings(token):
        if not token:
            return [("", 0.0, "")]
        out = []
        char, rest = token[0], token[1:]
        options = ([(char, 0.0)] if char.isalpha() else
                   [(c, toxicity.SUBSTITUTE) for c in toxicity.LEET.get(char, "")]
                   + [("", toxicity.NOISE), (" ", toxicity.BREAK)])
        for text, price in options:
            out += [(text + t, price + p, "") for t, p, _ in readings(rest)]
        return out

    def cost(text, price):
        context = "\0" * (langid.ORDER - 1)
        for c in text + " ":
            if c == " " and context[-1] in " \0":
                continue
            price += channel.bits(context, c)
            context = context[1:] + c
        return price

    for token in ("1d10t", "s(um", "m0r0n!"):
        best = min(readings(token), key=lambda r: cost(r[0], r[1]))
        assert channel.read(token) == " ".join(best[0].split())


def test_restored_texts(channel, spark):
    found = toxicity.restore_text("The 1d10t and s c u m, 2024", channel)
    assert found == "the idiot and scum 2024"
    docs = spark.createDataFrame([(1, None), (2, "cl0wn")], "doc_id bigint, text string")
    assert [r.restored for r in toxicity.restore(docs, channel).orderBy("doc_id").collect()] == [
        "", "clown"]


def test_edges(spark):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (2, 0, 1), (None, 0, 1), (3, None, None),
                                    (4, 0, 5)], "doc_id bigint, quality int, toxic int")
    found = toxicity.score_toxicity(edges(spark), labels).collect()
    assert len(found) == edges(spark).count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    none = toxicity.score_toxicity(nothing(spark), labels.limit(0))
    assert none.count() == 0


def test_held_out_documents(spark):
    """Plain and disguised insults in documents whose labels were not learnt from."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    disguised = docs.withColumn("text", F.when(langid.held_out(), F.regexp_replace(
        F.regexp_replace("text", "idiot", "1d10t"), "scum", "s.c.u.m")).otherwise(F.col("text")))
    for table in (docs, disguised):
        found = toxicity.score_toxicity(table, labels).join(labels, "doc_id").where("held_out")
        right = found.where("predicted = toxic").count()
        assert right / found.count() > 0.97
        wrong = found.where("predicted = 1 AND toxic = 0").count()
        assert wrong <= 0.01 * found.count()


def test_many_rare_toxic_words(spark):
    """A hundred toxic words without common stems, each in 1% of the toxic documents, and one in 30%."""
    import random
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=7)) for _ in range(400)]
    bad = ["".join(rng.choices(letters, k=8)) for _ in range(100)]
    rows, labels = [], []
    for i in range(6000):
        body = rng.choices(words, k=12)
        if toxic := i % 4 == 0:
            body[3] = bad[i // 4 % 100]
            if rng.random() < 0.3:
                body[5] = "plainlybad"
        rows.append((i, " ".join(body)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(docs, marks).join(marks, "doc_id").where("held_out").collect()
    caught = [r.predicted for r in found if r.toxic]
    assert sum(caught) >= 0.95 * len(caught)
    assert sum(r.predicted for r in found if not r.toxic) <= 0.01 * len(found)


@pytest.mark.parametrize("written, read", [
    ("i" + "d" * 70 + "iot", "idiot"), ("s" * 80 + "cum", "scum"), ("5(0rn" + "x" * 70, None),
    ("1d10t" + "-" * 70, "idiot"), ("1d10t" * 30, None), ("2024", "2024"), ("$$", "$$")])
def test_readings_of_any_length(channel, written, read):
    found = toxicity.restored(written, channel)
    assert found == read if read else (found.isalpha() or " " in found) and found != written


def test_tokens_without_letters_are_read(spark):
    docs = spark.createDataFrame([(i, "as ass lass gas sass at all") for i in range(60)],
                                 "doc_id bigint, text string")
    channel = toxicity.learn_channel(docs)
    assert [toxicity.restored(t, channel) for t in ("455", "4$$", "@5$")] == ["ass"] * 3


def test_spaced_runs_are_read_whole(channel):
    """A word across every place where runs were cut, 32 letters apart."""
    for before in range(24, 34):
        written = " ".join(("over" * 9)[:before] + "idiot" + "there" * 8)
        weights = {"=idiot": 0.9}
        run, = toxicity.spaced_out(written)
        assert run == written
        read = toxicity.restore_text(written, channel)
        assert read.replace(" ", "") == written.replace(" ", "")
        if before % 4 == 0:
            assert "idiot" in read.split()
            assert toxicity.Evidence(channel, weights).of(written) == {"=idiot"}


def test_letters_of_other_scripts_are_in_the_model(spark):
    """Cyrillic words, disguised by signs and by Latin look-alikes, and Latin ones by Cyrillic."""
    words = "дурак это все слова здесь там река дом окно камень idiot there moron scum".split()
    docs = spark.createDataFrame([(i, " ".join(words[i % 7:] + words[:i % 7])) for i in range(60)],
                                 "doc_id bigint, text string")
    channel = toxicity.learn_channel(docs)
    read = {w: toxicity.restored(w, channel) for w in ("дур@к", "дураааак", "idiоt", "mоrоn", "дурак")}
    assert read == {"дур@к": "дурак", "дураааак": "дурак", "idiоt": "idiot", "mоrоn": "moron",
                    "дурак": "дурак"}
