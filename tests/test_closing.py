"""Windows of a stream close once; late rows are kept."""

import pytest
from pyspark.sql import functions as F

from logtables.operators import fields, windows
from logtables.plans import inputs
from logtables.sinks import tables
from logtables.sources.runs import list_runs, read_runs
from logtables.spec import Exporter, FieldSet, FieldSpec, LogExportConfig
from logtables.streaming import closing
from logtables.streaming.export import read_stream

SF = "/root/testdata/sf0.001"
MINUTE, DAY = 60_000, 86_400_000
ONCE = {"availableNow": True}
SET = FieldSet((fields.HTTP, fields.TIMESTAMP))
CONFIG = LogExportConfig("s", SET, window_ms=DAY)


def sent(spark):
    """The logs in order of arrival, every fifth one a day late."""
    return inputs.core_logs(spark, SF).withColumn("arrival_usec", F.expr(
        f"start_time_usec + if(event_id % 5 = 0, {DAY}000L, event_id % 7 * 1000000L)"))


def slices(spark, folder, n, first=0, last=None):
    """Files in order of arrival."""
    rows = sent(spark).orderBy("arrival_usec").collect()
    size = -(-len(rows) // n)
    for i in range(first, n if last is None else last):
        spark.createDataFrame(rows[i * size:(i + 1) * size], sent(spark).schema).coalesce(
            1).write.mode("append").parquet(folder)


def export(spark, folder, root, config=CONFIG, **options):
    logs = read_stream(spark, folder, sent(spark).schema, max_files=1)
    closing.start_export(logs, config, root, f"{root}/state", ONCE, **options).awaitTermination()


def done_runs(spark, root):
    runs = list_runs(read_runs(spark, f"{root}/runs")).where("status = 'done'")
    return {r.window_start: r.row_count for r in runs.collect()}


def test_on_time_and_late_are_the_input_over_two_runs(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    slices(spark, source, 6, last=3)
    export(spark, source, root)
    half = done_runs(spark, root)
    assert half
    slices(spark, source, 6, first=3)
    export(spark, source, root)
    logs = sent(spark)
    late = closing.read_late(spark, root, CONFIG, logs.schema)
    expected = windows.late(logs, DAY)
    assert sorted(r.request_id for r in late.collect()) == sorted(
        r.request_id for r in expected.collect())
    assert {r.reason for r in late.collect()} == {closing.ARRIVED_LATE}
    assert all(r.late_by_ms == (r.arrival_usec // 1000 - r.window_start - DAY - MINUTE)
               for r in late.collect())
    # One finished run a window, although most were written in several batches.
    now = done_runs(spark, root)
    assert half.items() <= now.items()
    closing.close_windows(spark, CONFIG, root, 1_704_067_200_000 + 60 * DAY)
    on_time = windows.on_time(logs, DAY)
    found = tables.read_rows(spark, root, CONFIG)
    assert sorted(r.requestId for r in found.collect()) == sorted(
        r.request_id for r in on_time.collect())
    counts = windows.assign_window(on_time, DAY).groupBy("window_start").count().collect()
    runs = read_runs(spark, f"{root}/runs")
    assert done_runs(spark, root) == {r[0]: r[1] for r in counts}
    assert runs.where("status = 'done'").count() == len(counts)
    assert runs.where("status = 'written'").count() > len(counts)
    assert on_time.count() + expected.count() == logs.count()


def test_open_windows_are_not_seen(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    slices(spark, source, 2, last=1)
    export(spark, source, root)
    seen = {r.window_start for r in tables.read_rows(spark, root, CONFIG).collect()}
    assert seen == set(done_runs(spark, root))
    clock = sent(spark).orderBy("arrival_usec").limit(-(-sent(spark).count() // 2)).agg(
        F.max("arrival_usec")).first()[0]
    assert seen and max(seen) + DAY + MINUTE < clock // 1000
    span = tables.read_rows(spark, root, CONFIG, (min(seen), min(seen)))
    assert {r.window_start for r in span.collect()} == {min(seen)}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """As after a driver that died between its ledger record and the stream's commit."""
    root = str(tmp_path)
    rows = sent(spark).orderBy("arrival_usec").collect()
    parts = [spark.createDataFrame(rows[i * 140:(i + 1) * 140],
                                   sent(spark).schema) for i in range(3)]
    write = closing.write_batch(CONFIG, root)
    for number in (0, 1, 1, 2, 2, 2):
        write(parts[number], number)
    closing.close_windows(spark, CONFIG, root, 1_704_067_200_000 + 60 * DAY)
    logs = parts[0].unionAll(parts[1]).unionAll(parts[2])
    late = closing.read_late(spark, root, CONFIG, logs.schema)
    found = tables.read_rows(spark, root, CONFIG)
    assert found.count() + late.count() == logs.count()
    assert sum(done_runs(spark, root).values()) == found.count()


def test_rows_that_come_after_their_window_was_closed(spark, tmp_path):
    """They arrived in time but are delivered out of order."""
    root, logs = str(tmp_path), sent(spark).where("event_id % 5 != 0").withColumn(
        "arrival_usec", F.col("start_time_usec"))
    last = logs.agg(F.max("start_time_usec")).first()[0]
    write = closing.write_batch(CONFIG, root)
    ahead = logs.where(f"start_time_usec >= {last} - {2 * DAY}000L")
    write(ahead, 0)
    write(logs.where(f"start_time_usec < {last} - {2 * DAY}000L"), 1)
    late = closing.read_late(spark, root, CONFIG, logs.schema)
    assert {r.reason for r in late.collect()} == {closing.WINDOW_CLOSED}
    closing.close_windows(spark, CONFIG, root, last // 1000 + 3 * DAY)
    assert tables.read_rows(spark, root, CONFIG).count() + late.count() == logs.count()
    assert late.count() > 300


@pytest.mark.parametrize("compact", [2, 1000])
def test_rejects_of_closed_windows(spark, tmp_path, monkeypatch, compact):
    from logtables.sinks import journal
    monkeypatch.setattr(journal, "COMPACT", compact)
    config = LogExportConfig("s", FieldSet((fields.HTTP, Exporter("n", (
        FieldSpec("number", "integer", "substring(nickname, 5)"),)))), window_ms=DAY,
        max_row_bytes=10_000)
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    slices(spark, source, 3)
    export(spark, source, root, config)
    closing.close_windows(spark, config, root, 1_704_067_200_000 + 60 * DAY)
    on_time = windows.on_time(sent(spark), DAY)
    bad = tables.read_rejects(spark, root, config)
    assert bad.count() == on_time.where("nickname = ''").count() > 0
    assert bad.count() + tables.read_rows(spark, root, config).count() == on_time.count()


def test_an_empty_batch_and_no_stream(spark, tmp_path):
    assert closing.close_windows(spark, CONFIG, str(tmp_path), 0) == []
    logs = sent(spark)
    closing.write_batch(CONFIG, str(tmp_path))(logs.where("false"), 0)
    assert tables.read_rows(spark, str(tmp_path), CONFIG).count() == 0
    assert closing.read_late(spark, str(tmp_path), CONFIG, logs.schema).count() == 0
