"""Greedy batches over micro-batches equal those of the whole input."""

import random

import pytest

from logtables import session
from logtables.operators import batching
from logtables.plans import catalogue
from logtables.streaming import batches
from logtables.streaming.export import read_stream

SCHEMA = "g string, n bigint, size bigint"


def greedy(rows, limit):
    """Row by row, as the rule says."""
    open_, batch, out = {}, {}, []
    for g, n, size in sorted(rows, key=lambda r: (r[1], r[0] or "")):
        have = open_.get(g, 2)
        if have + size > limit:
            batch[g], have = batch.get(g, 0) + 1, 0
        open_[g] = have + size
        out.append((g, n, size, batch.get(g, 0)))
    return sorted(out, key=repr)


def parts(seed, micro):
    """Groups that come and go, one with most rows, null and new ones, sizes above the limit."""
    rng = random.Random(seed)
    names = ["a", "b", "c", None]
    rows = [(names[0] if rng.random() < 0.5 else rng.choice(names) if i < 500 else f"g{i % 7}", i,
             rng.choice([1, 3, 20, 60, 99, 130])) for i in range(900)]
    cuts = sorted(rng.sample(range(900), micro - 1))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 900])]


@pytest.mark.parametrize("seed, micro, slices", [(1, 3, 4), (2, 6, 1)])
def test_equal_to_the_whole_input(spark, tmp_path, seed, micro, slices):
    write = batches.write_batch(str(tmp_path), ["g"], ["n"], "size", 100, slices)
    given = parts(seed, micro)
    for i, rows in enumerate(given):
        df = spark.createDataFrame(rows, SCHEMA)
        write(df, i)
        if i == 1:
            write(df, i)
    found = batches.read_batches(spark, str(tmp_path), df.schema)
    assert sorted(map(tuple, found.collect()), key=repr) == greedy(sum(given, []), 100)
    whole = batching.byte_batches(spark.createDataFrame(sum(given, []), SCHEMA), ["g"], ["n"],
                                  "size", 100)
    assert sorted(map(tuple, whole.collect()), key=repr) == greedy(sum(given, []), 100)


def test_a_restarted_stream_goes_on(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    given = parts(3, 4)

    def run():
        stream = read_stream(spark, source, schema, max_files=1)
        batches.start_batches(stream, root, f"{root}/checkpoint", ["g"], ["n"], "size", 100,
                              {"availableNow": True}).awaitTermination()

    for pair in (given[:2], given[2:]):
        for rows in pair:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        run()
    found = batches.read_batches(spark, root, schema)
    assert sorted(map(tuple, found.collect()), key=repr) == greedy(sum(given, []), 100)
    assert len(list((tmp_path / "out" / "state").glob("micro=*"))) == 2


def test_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert batches.read_batches(spark, str(tmp_path), schema).count() == 0
    write = batches.write_batch(str(tmp_path), ["g"], ["n"], "size", 100)
    write(spark.createDataFrame([], schema), 0)
    write(spark.createDataFrame([("a", 1, 5)], schema), 1)
    found = batches.read_batches(spark, str(tmp_path), schema)
    assert [tuple(r) for r in found.collect()] == [("a", 1, 5, 0)]


def test_every_task_sends_what_it_has_read(spark, tmp_path, monkeypatch):
    """A part of the documents comes in several files and is one micro-batch; none goes through one task."""
    documents = spark.range(400).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, null, concat('l', id % 2)) AS lang",
        "repeat('x', cast(id * 37 % 9000 AS int)) AS text")
    documents.repartition(5).write.parquet(f"{tmp_path}/sf/documents.parquet")
    monkeypatch.setattr(session, "fresh_dir", lambda spark, label: f"{tmp_path}/{label}")
    found = catalogue.QUERIES["stream_batches"](spark, f"{tmp_path}/sf")
    given = [(r.lang, r.doc_id, len(r.text) + 1) for r in documents.collect()]
    assert sorted(((r.lang, r.doc_id, r.row_bytes, r.batch) for r in found.collect()),
                  key=repr) == greedy(given, catalogue.DOCUMENT_BATCH_BYTES)
    out = tmp_path / "stream_batches"
    assert len(list((out / "sent").glob("part-*.parquet"))) > 4
    assert len([f for f in (out / "checkpoint" / "commits").iterdir() if f.name.isdigit()]) == 4
