"""Small tables that hold what operators must cope with."""

import random

# Extra columns, named as the operators name things inside.
COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, "
           "kept string, length string, part int, tag string, _range string, _rejected int")
EXTRA = (7, "x", "y", 3, "z", "w", 9)
PASSAGE = ("this licence line is found in many documents and is long enough to be cut out of "
           "all of them but the first")


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


def edge_rows():
    """Nulls in all columns, empty and long texts, repeated rows, equal and nearly equal texts."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi".split()
    rng = random.Random(5)
    long = " ".join(rng.choice(words) + str(rng.randrange(500)) for _ in range(12_000))
    base = [rng.choice(words) + str(rng.randrange(900)) for _ in range(150)]
    near = [*base[:70], "changed", *base[71:]]
    return [
        row(1, "Hello World"), row(2, "hello world"), row(2, "hello world"), row(3, None, None),
        row(4, ""), row(5, ""), (None,) * 5 + EXTRA, row(None, "no id", None), row(6, "12 34 !!"),
        row(7, long), row(8, long + " end"), row(9, " ".join(base)), row(10, " ".join(near)),
        row(11, "intro one " + PASSAGE + " outro"), row(12, "another start " + PASSAGE),
        row(12, "the same id with another text " + PASSAGE), row(13, "ééé ßß 東京 \U0001f600"),
        row(14, "1d10t and a s c u m"), row(15, "\n\t  \n"),
    ]


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def edges(spark):
    return table(spark, edge_rows()).repartition(3)


def nothing(spark):
    return table(spark, [])
