import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logtables.operators import fields, windows
from logtables.plans import inputs, log_export, snapshot_export
from logtables.sinks import journal, snapshots, tables, vacuum
from logtables.sources.backups import read_kind
from logtables.sources.runs import list_runs, read_runs, run_by_id
from logtables.spec import Exporter, FieldSet, FieldSpec, LogExportConfig, SnapshotConfig

SF = "/root/testdata/sf0.001"
DAY = 86_400_000
T0 = 1_704_067_200_000
SET = FieldSet((fields.HTTP, fields.TIMESTAMP))


def planned(spark, first, count):
    return windows.plan_windows(windows.trigger_at(spark, first + DAY), DAY, count=count)


def test_an_export_runs_once_per_window(spark, tmp_path):
    root = str(tmp_path)
    config = LogExportConfig("web", SET, window_ms=DAY)
    logs = inputs.core_logs(spark, SF)
    middle = T0 + 2 * DAY
    log_export.export_windows(logs, config, planned(spark, middle, 1), root)
    log_export.export_windows(logs, config, planned(spark, T0, 5), root)
    log_export.export_windows(logs, config, planned(spark, T0, 5), root)
    found = tables.read_rows(spark, root, config)
    expected = logs.where(F.col("start_time_usec") < (T0 + 5 * DAY) * 1000)
    assert sorted(r.requestId for r in found.collect()) == sorted(
        r.request_id for r in expected.collect())
    runs = read_runs(spark, f"{root}/runs")
    assert sorted(r.window_start for r in runs.collect()) == [T0 + i * DAY for i in range(5)]
    assert runs.agg(F.sum("row_count")).first()[0] == expected.count()
    assert run_by_id(runs, f"web_{T0}_{T0 + DAY}").first().row_count > 0
    assert run_by_id(runs, "none").count() == 0


def test_windows_without_rows_are_recorded(spark, tmp_path):
    config = LogExportConfig("web", SET, window_ms=DAY)
    before = T0 - 10 * DAY
    log_export.export_windows(inputs.core_logs(spark, SF), config, planned(spark, before, 2),
                              str(tmp_path))
    assert [r.row_count for r in read_runs(spark, f"{tmp_path}/runs").collect()] == [0, 0]


def test_a_failed_export_publishes_nothing(spark, tmp_path):
    config = LogExportConfig("web", FieldSet((fields.HTTP, fields.USER)), window_ms=DAY)
    logs = inputs.core_logs(spark, SF)
    broken = logs.withColumn("nickname", F.when(F.col("event_id") != 3, F.col("nickname")))
    with pytest.raises(PySparkException, match="nickname"):
        log_export.export_windows(broken, config, planned(spark, T0, 31), str(tmp_path))
    failed = read_runs(spark, f"{tmp_path}/runs")
    assert {r.status for r in failed.collect()} == {"failed"} and failed.count() == 31
    assert tables.read_rows(spark, str(tmp_path), config).count() == 0
    assert not list((tmp_path / "web" / "data").glob("attempt=*"))
    log_export.export_windows(logs, config, planned(spark, T0, 31), str(tmp_path))
    assert tables.read_rows(spark, str(tmp_path), config).count() == logs.count()
    assert {r.status for r in list_runs(read_runs(spark, f"{tmp_path}/runs")).collect()} == {"done"}


def test_a_failure_before_the_ledger_publishes_neither_rows_nor_rejects(
        spark, tmp_path, monkeypatch):
    logs = inputs.core_logs(spark, SF)
    publish, calls = journal.Journal.publish, []

    def broken(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("no ledger")
        return publish(*args)

    monkeypatch.setattr(journal.Journal, "publish", broken)
    with pytest.raises(OSError):
        log_export.export_windows(logs, CHECKED, planned(spark, T0, 31), str(tmp_path))
    for read in (tables.read_rows, tables.read_rejects):
        assert read(spark, str(tmp_path), CHECKED).count() == 0
    log_export.export_windows(logs, CHECKED, planned(spark, T0, 31), str(tmp_path))
    assert tables.read_rows(spark, str(tmp_path), CHECKED).count() > 0


def test_only_wanted_windows_are_exported_and_once(spark, tmp_path):
    """Windows asked for twice, and a gap that a contiguity check would miss."""
    config = LogExportConfig("web", SET, window_ms=DAY)
    logs = inputs.core_logs(spark, SF)
    some = planned(spark, T0, 3).where(F.col("window_start") != T0 + DAY)
    log_export.export_windows(logs, config, some.unionAll(some), str(tmp_path))
    found = tables.read_rows(spark, str(tmp_path), config)
    assert {r.window_start for r in found.collect()} == {T0, T0 + 2 * DAY}
    runs = read_runs(spark, f"{tmp_path}/runs")
    assert sorted(r.window_start for r in runs.collect()) == [T0, T0 + 2 * DAY]


def test_a_bad_row_of_another_window_does_not_abort(spark, tmp_path):
    config = LogExportConfig("web", FieldSet((fields.HTTP, fields.USER)), window_ms=DAY)
    logs = inputs.core_logs(spark, SF).withColumn("nickname", F.expr(
        f"if(start_time_usec >= {(T0 + DAY) * 1000}L, NULL, nickname)"))
    some = planned(spark, T0, 1).unionAll(planned(spark, T0 - 3 * DAY, 1))
    log_export.export_windows(logs, config, some, str(tmp_path))
    gap = planned(spark, T0 - DAY, 1).unionAll(planned(spark, T0 + 40 * DAY, 1))
    log_export.export_windows(logs, config, gap, str(tmp_path))
    found = tables.read_rows(spark, str(tmp_path), config)
    assert {r.window_start for r in found.collect()} == {T0}


def test_another_time_column_leaves_finished_windows_alone(spark, tmp_path):
    config = LogExportConfig("web", SET, window_ms=DAY)
    logs = inputs.core_logs(spark, SF).withColumn("seen_usec", F.expr(
        "start_time_usec + if(event_id % 5 = 0, 86400000000L, 0)"))
    for i in (0, 1):
        log_export.export_windows(logs, config, planned(spark, T0 + i * DAY, 1), str(tmp_path),
                                  time="seen_usec")
    found = tables.read_rows(spark, str(tmp_path), config)
    expected = logs.where(F.col("seen_usec").between(T0 * 1000, (T0 + 2 * DAY) * 1000 - 1))
    assert sorted(r.requestId for r in found.collect()) == sorted(
        r.request_id for r in expected.collect())


def test_copies_are_removed_within_a_window(spark, tmp_path):
    """However the windows are grouped into runs, the same copies stay."""
    logs = inputs.core_logs(spark, SF).withColumn("request_id", F.expr(
        "cast(event_id div 2 AS string)")).drop("event_id")
    config = LogExportConfig("web", SET, window_ms=DAY)
    found = []
    for name, groups in (("one", [(0, 31)]), ("many", [(0, 7), (7, 24)])):
        for first, count in groups:
            log_export.export_windows(logs, config, planned(spark, T0 + first * DAY, count),
                                      str(tmp_path / name))
        found.append(sorted(map(tuple, tables.read_rows(
            spark, str(tmp_path / name), config).collect())))
    assert found[0] == found[1]
    assert len({(r[-1], r[SET.names.index("requestId")]) for r in found[0]}) == len(found[0])


CHECKED = LogExportConfig("web", FieldSet((fields.HTTP, Exporter("n", (
    FieldSpec("number", "integer", "substring(nickname, 5)"),)))), window_ms=DAY,
    max_row_bytes=10_000)


def test_rejects_are_set_aside(spark, tmp_path):
    logs = inputs.replays(inputs.core_logs(spark, SF))
    log_export.export_windows(logs, CHECKED, planned(spark, T0, 31), str(tmp_path))
    good = tables.read_rows(spark, str(tmp_path), CHECKED)
    bad = tables.read_rejects(spark, str(tmp_path), CHECKED)
    assert good.count() + bad.count() == inputs.core_logs(spark, SF).count()
    assert bad.count() == inputs.core_logs(spark, SF).where("nickname = ''").count()


def test_versions_default_to_the_running_one(spark):
    logs = inputs.core_logs(spark, SF)
    running = LogExportConfig("web", SET, running_version=("v1", "worker"))
    listed = LogExportConfig("web", FieldSet(SET.exporters, versions=(("v0", "default"),)),
                             running_version=("v1", "worker"))

    def pairs(config):
        found = log_export.select_logs(logs, config).select("version_id", "module_id").distinct()
        return sorted(tuple(r) for r in found.collect())

    assert pairs(running) == [("v1", "worker")]
    assert pairs(listed) == [("v0", "default")]
    assert len(pairs(LogExportConfig("web", SET))) == 6


def test_rewriting_a_window_replaces_only_it(spark, tmp_path):
    config = LogExportConfig("web", SET, window_ms=DAY)
    path = str(tmp_path / "rows")
    rows = log_export.window_rows(inputs.core_logs(spark, SF), config)
    tables.write_windows(rows, config, path)
    tables.write_windows(rows.where(F.col("window_start") == T0), config, path)
    assert tables.read_windows(spark, path, SET.schema()).count() == rows.count()


def test_created_tables_keep_their_columns(spark, tmp_path):
    name = f"default.t_{uuid.uuid4().hex}"
    tables.create_table(spark, name, SET.schema(), str(tmp_path / "t"))
    tables.create_table(spark, name, SET.schema(), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="other columns"):
        tables.create_table(spark, name, fields.BASIC.schema(), str(tmp_path / "t"))
    assert spark.table(name).columns == [*SET.names, "window_start"]


def test_csv_snapshots_may_hold_newlines(spark, tmp_path):
    folder = tmp_path / "K.backup_info"
    folder.mkdir()
    (folder / "a.csv").write_text('id,text\n1,"two\nlines"\n2,one\n')
    found = read_kind(spark, f"{tmp_path}/backup_info", "K", "csv", header="true", multiLine="true")
    assert [tuple(r) for r in found.collect()] == [("1", "two\nlines"), ("2", "one")]


def test_windows_reach_their_catalog_tables_once(spark, tmp_path):
    database = f"w_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    root = str(tmp_path / "tables")
    config = LogExportConfig("web", SET, window_ms=DAY)
    ids = tables.create_window_tables(spark, config, database, root, T0 + 2 * DAY)
    assert ids == ("202401", "202402")
    rows = log_export.window_rows(inputs.core_logs(spark, SF), config)
    early = rows.where(F.col("window_start") < T0 + 3 * DAY)
    for part in (early, rows, early):
        tables.insert_windows(part, config, database, root, ids)
    assert spark.table(f"{database}.web_202401").count() == rows.count()
    assert spark.table(f"{database}.web_202402").count() == 0
    with pytest.raises(PySparkException, match="no table was created"):
        tables.insert_windows(rows, config, database, root, ["202402"])
    plan = spark.table(f"{database}.web_202401").where(F.col("window_start") == T0)
    assert "PartitionFilters: [isnotnull(window_start" in plan._jdf.queryExecution().toString()


def test_table_ids(spark):
    config = LogExportConfig("web", SET)
    assert tables.table_ids(spark, config, T0 + 30 * DAY) == ("202401", "202402")
    assert tables.table_ids(spark, config, T0 - 1) == ("202312", "202401")


def snapshot_config(spark, tmp_path, **kw):
    database = f"s_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    return SnapshotConfig(("customer", "part"), str(tmp_path), database, **kw)


def test_snapshot_waits_for_its_handle(spark, tmp_path):
    config = snapshot_config(spark, tmp_path)
    assert snapshot_export.start(spark, inputs.entities(spark, SF), config, T0)
    assert snapshot_export.load_if_ready(spark, config, T0 + 1) == []


def test_skipped_load_creates_no_tables(spark, tmp_path):
    config = snapshot_config(spark, tmp_path, skip_load=True)
    assert snapshot_export.start(spark, inputs.entities(spark, SF), config, T0) == []
    assert spark.catalog.listTables(config.database) == []


def test_a_failed_load_leaves_the_old_data(spark, tmp_path):
    config = snapshot_config(spark, tmp_path)
    entities = inputs.entities(spark, SF)
    snapshot_export.start(spark, entities, config, T0)
    customers = entities["customer"].count()
    handle = snapshots.back_up(spark, entities, config, T0 + DAY)
    for file in tmp_path.glob("*/*/customer.backup_info/part-*"):
        if "2024_01_02" in str(file):
            file.write_bytes(b"not parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        snapshots.load(spark, config, handle, T0 + DAY)
    assert spark.table(f"{config.database}.customer").count() == customers
    runs = {r.run_id: r.status for r in list_runs(read_runs(spark, f"{tmp_path}/runs")).collect()}
    assert runs[f"load_customer_{T0}"] == "done"
    assert runs[f"load_customer_{T0 + DAY}"] == "failed"


def test_a_failing_backup_leaves_the_finished_one_whole(spark, tmp_path):
    config = snapshot_config(spark, tmp_path, skip_load=True)
    entities = inputs.entities(spark, SF)
    handle = snapshots.back_up(spark, entities, config, T0)
    entities["part"] = entities["part"].withColumn("bad", F.raise_error(F.lit("broken")))
    with pytest.raises(PySparkException, match="broken"):
        snapshots.back_up(spark, entities, config, T0)
    assert snapshots.read_catalogue(spark, config).count() == 1
    assert read_kind(spark, handle, "part").count() > 0


def test_a_replaced_folder_goes_after_a_time_of_grace(spark, tmp_path):
    config = snapshot_config(spark, tmp_path)
    entities = inputs.entities(spark, SF)
    snapshot_export.start(spark, entities, config, T0)
    reader = spark.table(f"{config.database}.part")
    snapshot_export.start(spark, entities, config, T0 + DAY)
    assert reader.count() == entities["part"].count()
    folders = tmp_path / "tables" / "part"
    assert len(list(folders.iterdir())) == 2
    assert vacuum.replaced_loads(spark, config, "part") == []
    assert len(vacuum.replaced_loads(spark, config, "part", 0)) == 1
    assert len(list(folders.iterdir())) == 1
    assert spark.table(f"{config.database}.part").count() == entities["part"].count()
    hasty = snapshot_config(spark, tmp_path / "other", keep_replaced_ms=0)
    for at in range(3):
        snapshot_export.start(spark, entities, hasty, T0 + at * DAY)
    assert len(list((tmp_path / "other" / "tables" / "part").iterdir())) == 1


def test_snapshots_load_other_formats(spark, tmp_path):
    config = snapshot_config(spark, tmp_path)
    for kind in config.kinds:
        inputs.entities(spark, SF)[kind].write.json(f"{tmp_path}/given/{kind}.backup_info")
    snapshots.load(spark, config, f"{tmp_path}/given/backup_info", T0, "json")
    assert "p_name" in spark.table(f"{config.database}.part").columns


def test_a_load_with_other_columns_replaces_the_table(spark, tmp_path):
    config = snapshot_config(spark, tmp_path)
    entities = inputs.entities(spark, SF)
    snapshot_export.start(spark, entities, config, T0)
    entities["part"] = entities["part"].withColumn("extra", F.lit(1))
    snapshot_export.start(spark, entities, config, T0 + DAY)
    assert "extra" in spark.table(f"{config.database}.part").columns


def test_configurations_are_checked():
    with pytest.raises(ValueError):
        SnapshotConfig((), "root")
    with pytest.raises(ValueError):
        LogExportConfig("", SET)


def test_an_export_has_tasks_by_its_size(spark, tmp_path, monkeypatch):
    """Rows that a task sorts do not grow with the input; copies still meet."""
    logs = inputs.core_logs(spark, SF).drop("event_time")
    logs.unionAll(logs).write.parquet(f"{tmp_path}/logs")
    logs = spark.read.parquet(f"{tmp_path}/logs")
    config = LogExportConfig("w", FieldSet((fields.HTTP, fields.TIMESTAMP)), window_ms=86_400_000)
    found = log_export.outcomes(logs, config)
    assert tables.tasks_of(found) is None
    size, _ = tables.batching.estimated_size(found._jdf.queryExecution().optimizedPlan())
    monkeypatch.setattr(tables, "TASK_BYTES", -(-size // 40))
    tasks = tables.tasks_of(found)
    assert tasks in (39, 40) and tables.spread_of(spark, 2, tasks) == 2 * tasks
    written = tables.write_attempt(found, config, str(tmp_path), "a", "requestId",
                                   tables.spread_of(spark, 2, tasks))
    path = tables.data_path(str(tmp_path), config, "a")
    rows = spark.read.parquet(path)
    assert len({r[0] for r in rows.select(F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1))
                .collect()}) > 8
    assert rows.count() == rows.select("requestId").distinct().count() == logs.select(
        "request_id").distinct().count() == sum(n["row_count"] for n in written.values())
