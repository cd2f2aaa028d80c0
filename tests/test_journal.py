"""The ledger's journal: windows once only, whatever runs at the same time, dies or is slow."""

import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from logtables.operators import fields, windows
from logtables.plans import inputs, log_export
from logtables.session import create_file, list_dir, read_file
from logtables.sinks import journal, tables, vacuum
from logtables.sinks.journal import Journal, run_of
from logtables.sources import runs
from logtables.spec import Exporter, FieldSet, FieldSpec, LogExportConfig

SF = "/root/testdata/sf0.001"
DAY = 86_400_000
T0 = 1_704_067_200_000
CONFIG = LogExportConfig("web", FieldSet((fields.HTTP, fields.TIMESTAMP)), window_ms=DAY)


def planned(spark, first, count):
    return windows.plan_windows(windows.trigger_at(spark, first + DAY), DAY, count=count)


def ids(df):
    return sorted(r.requestId for r in df.select("requestId").collect())


def run(start, **more):
    return run_of("web", start, DAY, **more)


def test_one_of_many_puts_a_file(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(inheritable_thread_target(spark)(
            lambda i: create_file(spark, path, f"text {i} é")), range(8)))
    assert sum(won) == 1 and read_file(spark, path) == f"text {won.index(True)} é"
    assert list(list_dir(spark, f"{tmp_path}/a")) == ["b.json"]
    assert list_dir(spark, f"{tmp_path}/none") == {}


def test_two_exports_at_the_same_time_give_each_row_once(spark, tmp_path):
    logs, root = inputs.core_logs(spark, SF), str(tmp_path)
    gate = threading.Barrier(3)

    def export(_):
        gate.wait()
        return log_export.export_windows(logs, CONFIG, planned(spark, T0, 31), root)

    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(export), range(3)))
    assert sorted(len(d) for d in done) == [0, 0, 31]
    found = tables.read_rows(spark, root, CONFIG)
    assert ids(found) == sorted(r.request_id for r in logs.collect())
    assert runs.read_runs(spark, f"{root}/runs").count() == 31


def test_two_runs_that_both_write_publish_each_window_once(spark, tmp_path, monkeypatch):
    """Claims that expire at once: both runs do the work, one of them is seen."""
    logs, root = inputs.core_logs(spark, SF), str(tmp_path)
    gate, write = threading.Barrier(2), tables.write_attempt

    def together(*args):
        gate.wait()
        return write(*args)

    monkeypatch.setattr(tables, "write_attempt", together)
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(
            lambda _: log_export.export_windows(logs, CONFIG, planned(spark, T0, 31), root,
                                                hold_ms=-1)), range(2)))
    assert sorted(len(d) for d in done) == [0, 31]
    assert ids(tables.read_rows(spark, root, CONFIG)) == sorted(r.request_id for r in logs.collect())


def test_windows_of_a_dead_run_are_taken_over(spark, tmp_path):
    logs, root = inputs.core_logs(spark, SF), str(tmp_path)
    dead = Journal(spark, f"{root}/runs", "web")
    some = [T0 + i * DAY for i in range(0, 31, 2)]
    # One holds its windows still, the other no longer.
    assert dead.claim(some[:4], "alive") == some[:4]
    assert dead.claim(some[4:], "dead", hold_ms=-1) == some[4:]
    done = log_export.export_windows(logs, CONFIG, planned(spark, T0, 31), root)
    assert set(done) == {T0 + i * DAY for i in range(31)} - set(some[:4])
    # The dead one was only slow: it comes too late for all but nothing of its own.
    assert dead.publish("dead", [run(w, row_count=5) for w in some[4:]]) == []
    held = tables.read_rows(spark, root, CONFIG)
    # No log is of the last day.
    assert {r.window_start for r in held.select("window_start").distinct().collect()} == {
        w for w in done if w != T0 + 30 * DAY}
    assert [r["window_start"] for r in dead.publish("alive", [run(w) for w in some[:4]])] == some[:4]


def test_a_slow_run_publishes_what_is_still_its_own(spark, tmp_path):
    log = Journal(spark, f"{tmp_path}/runs", "web")
    assert log.claim([1, 2, 3], "slow", hold_ms=-1) == [1, 2, 3]
    assert log.claim([2], "other") == [2]
    assert log.claim([1, 2, 3], "third") == [1, 3]
    assert log.publish("slow", [run(w) for w in (1, 2, 3)]) == []
    assert log.publish("third", [run(w) for w in (1, 3)])
    assert log.claim([1, 2, 3, 4], "more", hold_ms=-1) == [4]
    assert log.publish("other", [run(2)]) and log.publish("more", [run(4)])
    done = runs.read_runs(spark, f"{tmp_path}/runs").where("status = 'done'")
    assert sorted((r.window_start, r.location) for r in done.collect()) == [
        (1, "third"), (2, "other"), (3, "third"), (4, "more")]


def test_a_slow_run_that_fails_takes_nothing_back(spark, tmp_path):
    """Its windows were published by another one: they stay so, also in a checkpoint."""
    log = Journal(spark, f"{tmp_path}/runs", "web")
    log.claim([1, 2], "slow", hold_ms=-1)
    log.claim([1], "other")
    log.publish("other", [run(1, row_count=4)])
    assert log.give_up("slow", [1, 2], [run(1), run(2)])
    for _ in range(2):
        found = runs.list_runs(runs.read_runs(spark, f"{tmp_path}/runs"))
        assert {r.window_start: r.status for r in found.collect()} == {1: "done", 2: "failed"}
        assert log.published(log.state(), [1, 2]) == {1}
        log.compact(1)
    assert log.claim([1, 2], "again") == [2]


def test_a_failure_after_publishing_keeps_the_data(spark, tmp_path, monkeypatch):
    """The record was put, but its writer was told otherwise."""
    logs, root, publish = inputs.core_logs(spark, SF), str(tmp_path), Journal.publish

    def lost(*args):
        publish(*args)
        raise OSError("connection lost")

    monkeypatch.setattr(Journal, "publish", lost)
    assert len(log_export.export_windows(logs, CONFIG, planned(spark, T0, 31), root)) == 31
    assert tables.read_rows(spark, root, CONFIG).count() == logs.count()
    assert {r.status for r in runs.read_runs(spark, f"{root}/runs").collect()} == {"done"}


def test_rows_without_an_id_all_stay(spark, tmp_path):
    """A thousand rows, equal ones among them, no two of which are copies."""
    logs = inputs.core_logs(spark, SF).limit(100).crossJoin(spark.range(10)).drop("event_id")
    logs = logs.withColumn("request_id", F.lit(None).cast("string"))
    loose = LogExportConfig("web", FieldSet((fields.TIMESTAMP,)), window_ms=DAY)
    for config, insert_id in ((loose, None), (LogExportConfig("ids", FieldSet((
            fields.TIMESTAMP, fields.USER)), window_ms=DAY), "nickname")):
        rows = logs.withColumn("nickname", F.when(F.col("id") > 3, F.lit(""))) if insert_id else logs
        if insert_id:
            rows = rows.withColumn("nickname", F.coalesce("nickname", F.lit("")))
        log_export.export_windows(rows, config, planned(spark, T0, 31), str(tmp_path),
                                  insert_id=insert_id)
    assert tables.read_rows(spark, str(tmp_path), loose).count() == 1000


def test_null_ids_beside_others(spark, tmp_path):
    logs = inputs.core_logs(spark, SF)
    found = log_export.window_rows(logs, CONFIG).withColumn("outcome", F.lit("rows"))
    found = found.unionAll(found).withColumn("requestId", F.when(
        F.col("timestamp") % 2 == 0, F.col("requestId")))
    kept = tables.write_attempt(found, CONFIG, str(tmp_path), "a", "requestId", 4)
    even = logs.where("start_time_usec % 2 = 0").count()
    assert sum(w["row_count"] for w in kept.values()) == even + 2 * (logs.count() - even)


def test_a_hot_id_is_merged_ahead_of_the_exchange(spark, tmp_path):
    """The same rows stay with and without; few of a thousand copies are shuffled."""
    logs = inputs.core_logs(spark, SF).withColumn("request_id", F.when(
        F.col("event_id") % 3 > 0, F.lit("hot")).when(F.col("event_id") % 2 == 0, F.col("request_id")))
    sent = logs.crossJoin(spark.range(5)).drop("id")
    config = LogExportConfig("web", FieldSet((fields.TIMESTAMP, Exporter("id", (
        FieldSpec("requestId", "string", "request_id", nullable=True),)))), window_ms=DAY)
    found = log_export.window_rows(sent, config).withColumn("outcome", F.lit("rows")).coalesce(2)
    both = []
    for name, merge in (("plain", False), ("merged", True)):
        tables.write_attempt(found, config, str(tmp_path), name, "requestId", 4, None, merge)
        both.append(sorted(map(tuple, spark.read.parquet(
            tables.data_path(str(tmp_path), config, name)).select(
            "window_start", "timestamp", "requestId").collect()), key=repr))
    assert both[0] == both[1]
    assert sum(r[2] == "hot" for r in both[0]) == len({r[0] for r in both[0] if r[2] == "hot"})
    assert sum(r[2] is None for r in both[0]) == sent.where("request_id IS NULL").count()


@pytest.mark.parametrize("observed", [200, 0])
def test_the_write_counts_its_rows(spark, tmp_path, monkeypatch, observed):
    """By window and outcome, without a job after the write; beyond a number of windows from files."""
    monkeypatch.setattr(tables, "OBSERVED", observed)
    from tests.test_tables import CHECKED
    logs, root = inputs.core_logs(spark, SF), str(tmp_path)
    log_export.export_windows(logs, CHECKED, planned(spark, T0 - DAY, 33), root)
    last = runs.read_runs(spark, f"{root}/runs").collect()
    assert len(last) == 33 and sum(r.row_count == 0 for r in last) == 3
    good, bad = (read(spark, root, CHECKED).groupBy("window_start").count().collect()
                 for read in (tables.read_rows, tables.read_rejects))
    assert {r.window_start: r.row_count for r in last if r.row_count} == {
        r[0]: r[1] for r in good}
    assert {r.window_start: r.reject_count for r in last if r.reject_count} == {
        r[0]: r[1] for r in bad}


def test_counting_takes_no_job_of_its_own(spark, tmp_path):
    logs = inputs.core_logs(spark, SF)
    logs.write.parquet(f"{tmp_path}/logs")
    found = log_export.outcomes(spark.read.parquet(f"{tmp_path}/logs"), CONFIG)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("counted", "one write")
    try:
        tables.write_attempt(found, CONFIG, str(tmp_path), "a", "requestId", 2,
                             [T0 + i * DAY for i in range(31)])
        with_windows = len(tracker.getJobIdsForGroup("counted"))
        context.setJobGroup("read", "one write, counted from its files")
        tables.write_attempt(found, CONFIG, str(tmp_path), "b", "requestId", 2)
        assert len(tracker.getJobIdsForGroup("read")) > with_windows
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_readers_open_what_the_ledger_names(spark, tmp_path):
    """Neither attempts that were not published nor windows that are not asked for are listed."""
    logs, root = inputs.core_logs(spark, SF), str(tmp_path)
    for i in range(3):
        tables.write_attempt(log_export.outcomes(logs, CONFIG), CONFIG, root, f"dead-{i}",
                             "requestId", 1)
    log_export.export_windows(logs, CONFIG, planned(spark, T0, 10), root)
    log_export.export_windows(logs, CONFIG, planned(spark, T0, 31), root)
    attempts = tmp_path / "web" / "data"
    there = [p for p in attempts.rglob("*.parquet")]
    whole = tables.read_rows(spark, root, CONFIG)
    assert len(whole.inputFiles()) == sum("dead" not in str(p) for p in there) < len(there)
    assert whole.count() == logs.count()
    some = tables.read_rows(spark, root, CONFIG, (T0 + 3 * DAY, T0 + 4 * DAY))
    wanted = [p for p in there if "dead" not in str(p)
              and f"window_start={T0 + 3 * DAY}" in str(p) or "dead" not in str(p)
              and f"window_start={T0 + 4 * DAY}" in str(p)]
    assert len(some.inputFiles()) == len(wanted) > 0
    paths = tables.published_paths(runs.read_runs(spark, f"{root}/runs", "web"), root, CONFIG,
                                   "rows", True)
    assert len(paths) == 2
    # Files nobody may read are of no interest: they need not even be readable.
    for p in there:
        if "dead" in str(p) or f"window_start={T0}" in str(p):
            p.write_bytes(b"broken")
    assert some.count() == sum(1 for r in logs.collect()
                               if T0 + 3 * DAY <= r.start_time_usec // 1000 < T0 + 5 * DAY)


def test_a_million_runs_open_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(journal, "RUNS_PER_FILE", 100_000)
    monkeypatch.setattr(journal, "COMPACT", 5)
    log = Journal(spark, f"{tmp_path}/runs", "web")
    folder = tmp_path / "runs" / "config=web"
    minute = 60_000
    made = spark.range(1_000_000).select(
        F.concat_ws("_", F.lit("web"), T0 + F.col("id") * minute,
                    T0 + (F.col("id") + 1) * minute).alias("run_id"),
        (T0 + F.col("id") * minute).alias("window_start"),
        (T0 + (F.col("id") + 1) * minute).alias("window_end"), F.lit(7).cast("bigint").alias(
            "row_count"), F.lit(0).cast("bigint").alias("reject_count"),
        F.lit("202401").alias("table_id"), F.lit("done").alias("status"), F.lit("a").alias(
            "location"), F.lit(True).alias("whole"), F.lit(5).cast("bigint").alias("recorded_ms"),
        F.lit(0).cast("bigint").alias("record"))
    made.repartitionByRange(10, "run_id").sortWithinPartitions("run_id").write.parquet(
        f"{folder}/runs-made")
    create_file(spark, f"{folder}/{runs.CHECKPOINT.format(0)}", json.dumps(
        {"folder": "runs-made", "claims": {}}))
    for i in range(12):
        log.append(f"batch-{i}", [run(T0 + i * minute, row_count=i) | {
            "run_id": f"web_{T0 + i * minute}_batch-{i}"}])
    names = list_dir(spark, str(folder))
    base, tail = runs.latest(names)
    assert runs.numbered(base) >= 10 and len(tail) <= 5
    found = runs.read_runs(spark, f"{tmp_path}/runs")
    assert found.count() == 1_000_012 and len(found.inputFiles()) <= 11
    # A lookup and a span go to the files whose statistics allow it.
    wanted = f"web_{T0 + 654_321 * minute}_{T0 + 654_322 * minute}"
    one = runs.find_run(spark, f"{tmp_path}/runs", wanted)
    assert [r.row_count for r in one.collect()] == [7]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(run_id," in plan
    assert log.published(log.state(), [T0 - minute, T0 + 99 * minute]) == {T0 + 99 * minute}
    assert log.claim([T0, T0 + 2_000_000 * minute], "new") == [T0 + 2_000_000 * minute]


def test_compaction_keeps_claims_and_the_last_record_of_a_run(spark, tmp_path):
    log = Journal(spark, f"{tmp_path}/runs", "web")
    log.claim([1, 2], "a")
    log.give_up("a", [1, 2], [run(1), run(2)])
    log.claim([1], "b")
    log.publish("b", [run(1, row_count=9)])
    log.claim([2], "c")
    before = {r.run_id: (r.status, r.row_count) for r in runs.list_runs(
        runs.read_runs(spark, f"{tmp_path}/runs")).collect()}
    log.compact(1)
    after = {r.run_id: (r.status, r.row_count) for r in runs.list_runs(
        runs.read_runs(spark, f"{tmp_path}/runs")).collect()}
    assert before == after == {run(1)["run_id"]: ("done", 9), run(2)["run_id"]: ("failed", 0)}
    state = log.state()
    assert state.claims.keys() == {2} and state.tail == 0 and state.next == 5
    assert log.claim([1, 2, 3], "d") == [3]
    log.publish("d", [run(3)])
    log.compact(1)
    names = set(list_dir(spark, log.folder))
    # What a checkpoint has replaced goes when it is old; what is left reads the same.
    gone = log.clean(0)
    assert set(gone) < names and len(set(list_dir(spark, log.folder))) == 2
    assert runs.read_runs(spark, f"{tmp_path}/runs").count() == 3
    assert log.state().claims.keys() == {2}


def test_writers_at_the_same_time_lose_no_record(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(journal, "COMPACT", 4)
    log = Journal(spark, f"{tmp_path}/runs", "web")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(inheritable_thread_target(spark)(
            lambda i: log.append(f"batch-{i}", [run(i) | {"run_id": f"web_{i}"}])), range(16)))
    found = runs.list_runs(runs.read_runs(spark, f"{tmp_path}/runs"))
    assert sorted(r.window_start for r in found.collect()) == list(range(16))


def test_orphans_go_and_what_is_alive_stays(spark, tmp_path):
    logs, root = inputs.core_logs(spark, SF), str(tmp_path)
    log = Journal(spark, f"{root}/runs", "web")
    log_export.export_windows(logs, CONFIG, planned(spark, T0, 5), root)
    for name in ("killed", "running"):
        tables.write_attempt(log_export.outcomes(logs, CONFIG), CONFIG, root, name, "requestId", 1)
    log.claim([T0 + 20 * DAY], "running")
    log.claim([T0 + 21 * DAY], "killed", hold_ms=-1)
    assert vacuum.attempts(spark, root, CONFIG, 3_600_000) == []
    assert vacuum.attempts(spark, root, CONFIG, 0) == ["attempt=killed"]
    assert len(list((tmp_path / "web" / "data").glob("attempt=*"))) == 2
    assert tables.read_rows(spark, root, CONFIG).count() == logs.where(
        F.col("start_time_usec") < (T0 + 5 * DAY) * 1000).count()
    assert vacuum.attempts(spark, f"{root}/none", CONFIG, 0) == []


def test_unfinished_backups_go(spark, tmp_path):
    from logtables.sinks import snapshots
    from logtables.spec import SnapshotConfig
    config = SnapshotConfig(("part",), str(tmp_path), skip_load=True)
    entities = inputs.entities(spark, SF)
    handle = snapshots.back_up(spark, entities, config, T0)
    broken = {"part": entities["part"].withColumn("bad", F.raise_error(F.lit("broken")))}
    with pytest.raises(Exception, match="broken"):
        snapshots.back_up(spark, broken, config, T0)
    (tmp_path / "snapshot1_x" / "dead").mkdir(parents=True)
    gone = vacuum.backups(spark, config, 0)
    assert "snapshot1_x/dead" in gone and handle.rsplit("/", 2)[1] not in " ".join(gone)
    assert vacuum.backups(spark, config, 0) == []
    from logtables.sources.backups import read_kind
    assert read_kind(spark, handle, "part").count() == entities["part"].count()
