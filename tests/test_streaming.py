from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import functions as F

from logtables.operators import combine, fields, windows
from logtables.plans import inputs, log_export
from logtables.sinks import tables
from logtables.sources.runs import list_runs, read_runs
from logtables.spec import Exporter, FieldSet, FieldSpec, LogExportConfig
from logtables.streaming import export as stream

SF = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}
SCHEMA = "request_id string, event_time timestamp"


def slice_of(spark, folder, rows):
    at = [(i, datetime(2024, 1, 1, 0, m, s, tzinfo=UTC)) for i, m, s in rows]
    spark.createDataFrame(at, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_late_and_replayed_rows_are_dropped_across_runs(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        kept = stream.drop_replays(stream.read_stream(spark, source, schema, max_files=1))
        stream.start_append(kept, out, state, ONCE).awaitTermination()
        return sorted(r.request_id for r in spark.read.schema(schema).parquet(out).collect())

    slice_of(spark, source, [("a", 10, 0), ("a", 10, 0), ("b", 10, 30)])
    assert run() == ["a", "b"]
    # The watermark stands at 10:30 - 60 s: `late` is below it, `b` comes a second time.
    slice_of(spark, source, [("late", 8, 0), ("b", 10, 30), ("c", 10, 20)])
    assert run() == ["a", "b", "c"]


def test_copies_merge_within_a_task():
    batch = pa.RecordBatch.from_pydict({
        "k": ["a", "a", None, "b", None, "a"], "t": pa.array([1, 1, 1, 1, 1, 2], pa.timestamp("us"))})
    found = list(combine.first_copies("k", "t")([batch]))[0]
    assert found.column("k").to_pylist() == ["a", None, "b", "a"]


def test_a_hot_key_is_kept_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    slice_of(spark, source, [("hot", 10, 0)] * 3000 + [(str(i), 10, 1) for i in range(50)])
    schema = spark.createDataFrame([], SCHEMA).schema
    kept = stream.drop_replays(stream.read_stream(spark, source, schema))
    stream.start_append(kept, out, state, ONCE).awaitTermination()
    assert spark.read.schema(schema).parquet(out).count() == 51


def test_merging_copies_ahead_changes_nothing(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    slice_of(spark, source, [("hot", 10, 0)] * 500 + [(str(i), 10, 1) for i in range(50)])
    schema = spark.createDataFrame([], SCHEMA).schema
    kept = stream.drop_replays(stream.read_stream(spark, source, schema), merge_copies=True)
    stream.start_append(kept, out, state, ONCE).awaitTermination()
    assert spark.read.schema(schema).parquet(out).count() == 51


ODD = FieldSet((fields.HTTP, fields.TIMESTAMP, Exporter("odd", (
    FieldSpec("userNumber", "integer", "substring(nickname, 5)"),
    FieldSpec("padding", "string", "if(event_id % 11 = 0, repeat('x', 1000), '')")))))


def test_the_stream_equals_the_batch_export(spark, tmp_path):
    """Replays, bad and over-size values, table routing."""
    config = LogExportConfig("s", ODD, window_ms=86_400_000, max_row_bytes=900)
    sent = inputs.replays(inputs.log_stream(spark, SF))
    stream.start_export(sent, config, f"{tmp_path}/stream", f"{tmp_path}/state",
                        ONCE).awaitTermination()
    logs = inputs.replays(inputs.core_logs(spark, SF))
    planned = windows.assign_window(logs, config.window_ms).select("window_start", "window_end")
    log_export.export_windows(logs, config, planned, f"{tmp_path}/batch")
    for read in (tables.read_rows, tables.read_rejects):
        one, other = (read(spark, f"{tmp_path}/{name}", config) for name in ("stream", "batch"))
        names = [c for c in one.columns if c != "field_lengths"]
        assert sorted(map(tuple, one.select(names).collect()), key=repr) == sorted(
            map(tuple, other.select(names).collect()), key=repr)
        assert one.count() > 0


def test_a_batch_run_again_replaces_its_own_files(spark, tmp_path):
    root = str(tmp_path)
    config = LogExportConfig("s", FieldSet((fields.HTTP, fields.TIMESTAMP)), window_ms=86_400_000)
    logs = inputs.core_logs(spark, SF)
    halves = [logs.where(F.col("event_id") % 2 == i) for i in (0, 1)]
    write = stream.write_batch(config, root)
    for batch_id in (0, 0, 1, 1):
        write(halves[batch_id], batch_id)
    # A window shared by both batches keeps both parts.
    found = tables.read_rows(spark, root, config)
    assert sorted(r.requestId for r in found.collect()) == sorted(
        r.request_id for r in logs.collect())
    runs = list_runs(read_runs(spark, f"{root}/runs"))
    assert runs.agg(F.sum("row_count")).first()[0] == logs.count()


def test_the_default_cadence_is_a_minute(spark, tmp_path):
    """The first batch comes at once, the next with the next minute."""
    root = str(tmp_path)
    config = LogExportConfig("s", FieldSet((fields.HTTP, fields.TIMESTAMP)), window_ms=86_400_000)
    query = stream.start_export(inputs.log_stream(spark, SF), config, root, f"{root}/state")
    try:
        query.processAllAvailable()
        assert tables.read_rows(spark, root, config).count() == inputs.core_logs(spark, SF).count()
        assert stream.EVERY_MINUTE == {"processingTime": "1 minute"}
        assert query.isActive
    finally:
        query.stop()
