import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logtables.llm import streamdedup

from .cases import edge_rows, edges, nothing

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LOW = -(1 << 63)


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").translate(FOLD)].append(LOW if doc_id is None else doc_id)
    out = []
    for text, ids in groups.items():
        keep, first = max(ids), True
        for i in sorted(ids, reverse=True):
            kept = i == keep and first
            first = first and not kept
            out.append((None if i == LOW else i, None if keep == LOW else keep, len(ids), kept,
                        hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [
    streamdedup.sha256, lambda c: F.unhex(F.left(F.sha2(c.cast("binary"), 256), F.lit(2))),
    lambda c: F.unhex(F.lit("00"))])
def test_groups(spark, digest):
    """A weak digest brings different texts together; their bytes part them."""
    found = streamdedup.duplicates(edges(spark), digest=digest)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(edge_rows())


def test_nothing(spark):
    assert streamdedup.duplicates(nothing(spark)).count() == 0


def test_the_state_goes_on_where_it_stopped(spark, tmp_path):
    """A second run of the stream sees what came since and remembers the rest."""
    place = str(tmp_path)
    rows = [(i, bytes([i % 3]), b"s", "f", 1) for i in range(6)]
    schema = "id bigint, digest binary, sha binary, locator string, copies bigint"

    def run(part):
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{place}/in")
        stream = spark.readStream.schema(schema).parquet(f"{place}/in")
        streamdedup.consume(stream, f"{place}/state", f"{place}/checkpoint")
        found = streamdedup.seen(spark, f"{place}/state").collect()
        return sorted((bytes(r.digest), r.keep_id, r.group_size) for r in found)

    assert run(rows[:2]) == [(b"\0", 0, 1), (b"\1", 1, 1)]
    assert run(rows[2:]) == [(b"\0", 3, 2), (b"\1", 4, 2), (b"\2", 5, 2)]


def test_only_spark_functions_run(spark):
    plan = streamdedup.duplicates(edges(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
