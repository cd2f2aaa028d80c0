import pytest
from pyspark.sql import functions as F

from logtables.functions import keys, times
from logtables.operators import windows
from logtables.plans import inputs
from logtables.sources import backups, manifest
from logtables.sources.logs import scan_range

T0 = 1_704_067_200_000


def test_align_truncates_toward_zero(spark):
    values = spark.createDataFrame([(-7,), (-1,), (0,), (7,), (8,)], "v bigint")
    assert [r[0] for r in values.select(times.align(F.col("v"), 4)).collect()] == [-4, 0, 0, 4, 8]


def test_range_is_half_open(spark):
    stored = spark.createDataFrame([(T0 - 1,), (T0,), (T0 + 59_999,), (T0 + 60_000,)], "ms bigint")
    logs = stored.select((F.col("ms") * 1000).alias("start_time_usec"),
                         F.timestamp_millis("ms").alias("at"),
                         F.timestamp_millis("ms").cast("timestamp_ntz").alias("local_at"),
                         F.timestamp_millis("ms").cast("date").alias("day"))
    for column in ("start_time_usec", "at", "local_at"):
        kept = scan_range(logs, T0, T0 + 60_000, time=column, day="day")
        assert [r[0] // 1000 for r in kept.select("start_time_usec").collect()] == [T0, T0 + 59_999]


def test_range_reaches_the_parquet_scan(spark):
    logs = inputs.core_logs(spark, "/root/testdata/sf0.001")
    plan = scan_range(logs, T0, T0 + 1, time="event_time")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan and "LessThan(ts," in plan


def test_planned_windows(spark):
    now = T0 + 90_500
    planned = windows.plan_windows(windows.trigger_at(spark, now), 60_000).orderBy("window_start")
    found = planned.collect()
    assert len(found) == 60
    assert found[0] == (T0, T0 + 60_000, T0 + 120_000)
    assert found[-1].window_start == T0 + 59 * 60_000
    assert windows.due_windows(planned, T0 + 119_999).count() == 0
    assert windows.due_windows(planned, T0 + 180_000).count() == 2


def test_pending_windows_mind_configuration_and_status(spark):
    planned = windows.plan_windows(windows.trigger_at(spark, T0 + 60_000), 60_000, count=3)
    runs = spark.createDataFrame(
        [("web", T0, "done"), ("jobs", T0 + 60_000, "done"), ("web", T0 + 120_000, "failed")],
        "config string, window_start bigint, status string"
    ).withColumn("window_end", F.col("window_start") + 60_000)
    pending = windows.pending_windows(planned, runs, "web").orderBy("window_start").collect()
    assert [r.window_start for r in pending] == [T0 + 60_000, T0 + 120_000]


def test_lateness_bound(spark):
    end = (T0 + 60_000 + 60_000) * 1000
    logs = spark.createDataFrame([(T0 * 1000, end), (T0 * 1000, end + 1)],
                                 "start_time_usec bigint, arrival_usec bigint")
    assert [r.arrival_usec for r in windows.on_time(logs, 60_000).collect()] == [end]
    assert [r.arrival_usec for r in windows.late(logs, 60_000).collect()] == [end + 1]


def test_assigned_windows_equal_tumbling_windows(spark):
    logs = inputs.core_logs(spark, "/root/testdata/sf0.001")
    both = windows.assign_window(logs, 3_600_000).select(
        "window_start", F.window(F.timestamp_micros("start_time_usec"), "1 hour").alias("w"))
    assert both.where("window_start <> unix_millis(w.start)").count() == 0


def test_key_functions(spark):
    one = spark.range(1)
    h, a, b = F.lit("abc123"), F.lit(5).cast("bigint"), F.lit(60).cast("bigint")
    key = one.select(keys.log_key(h, a, b)).first()[0]
    assert key == keys.log_key_text("abc123", 5, 60) == "log_abc123_" + "5".zfill(20) + "_" + "60".zfill(20)
    assert one.select(keys.key_end_ms(F.lit(key + "__"))).first()[0] == 60
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one.select(keys.key_end_ms(F.lit(key + ".schema"))).collect()


def test_manifest_range_bounds(spark):
    def key(start):
        return keys.log_key_text("aaaaaa", start, start + 10)
    listed = [key(0), key(10), key(20), key(30), keys.log_key_text("aaaaaa", 10, 10),
              keys.log_key_text("bbbbbb", 10, 20)]
    listed += [k + ".schema" for k in listed]
    table = spark.createDataFrame([(k,) for k in listed], "key string")
    found = manifest.log_uris(table, "b", "aaaaaa", 10, 30).select("key").collect()
    assert sorted(r.key for r in found) == [key(10), key(20)]
    # The marker key itself is left out, its schema sibling sorts after it.
    schemas = manifest.log_uris(table, "b", "aaaaaa", 10, 30, read_schemas=True)
    assert sorted(r.uri for r in schemas.collect()) == [
        "gs://b/" + k for k in sorted([key(10), key(20), keys.log_key_text("aaaaaa", 10, 10)])]


def test_backup_lookup(spark):
    info = spark.createDataFrame(
        [("p1_b", 1, "/gs/low"), ("p1_2024_02", None, "/gs/x/gs/backup_info"), ("p1_2024_03", 2, "h"),
         ("p2_2024", 3, None), ("p2_2025", 4, "h")],
        "name string, complete_time bigint, gs_handle string")
    first = backups.find_backup(info, 1, "p")
    assert first.first().name == "p1_2024_02"
    assert backups.ready(first).count() == 1
    assert backups.ready(backups.find_backup(info, 2, "p")).count() == 0
    assert backups.find_backup(info, 3, "p").count() == 0
    uris = backups.kind_uris(first, ["K", "L"], 7).orderBy("kind").collect()
    assert [(r.uri, r.table_name) for r in uris] == [
        ("gs://xgs://K.backup_info", "K7"), ("gs://xgs://L.backup_info", "L7")]
    assert keys.kind_uri_text("/gs/x/backup_info", "K") == "gs://x/K.backup_info"
    assert keys.backup_name(5, None) == "snapshot5_"
