"""The registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtables import session
from logtables.functions import keys, schemas, times
from logtables.functions import rows as row_text
from logtables.operators import batching, dedup, fields, filters, reports, rows, windows
from logtables.plans import inputs, log_export, snapshot_export
from logtables.sinks import journal, snapshots, tables, vacuum
from logtables.sinks import logs as log_store
from logtables.sources import backups, logs, manifest
from logtables.sources import runs as run_source
from logtables.spec import Exporter, FieldSet, FieldSpec, LogExportConfig, SnapshotConfig
from logtables.streaming import batches, closing
from logtables.streaming import export as stream

Query = Callable[[SparkSession, str], DataFrame]

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000
JAN_1 = 1_704_067_200_000
JAN_5 = JAN_1 + 4 * DAY
JAN_12 = JAN_1 + 11 * DAY
UNFINISHED_BACKUP = 788_918_400_000 + DAY
FINISHED_BACKUP = 788_918_400_000 + 2 * DAY
RUN_ID = f"load_part_{JAN_5}"
DOCUMENT_BATCH_BYTES = 50_000
LOG_BATCH_BYTES = 20_000
EVENT_BATCH_BYTES = 300
MAX_ROW_BYTES = 385

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _group(exporter: Exporter) -> FieldSet:
    return FieldSet((exporter,))


# Field sets and configurations the queries run with.

SKIP = "http_status = 500 OR nullif(nickname, '') = 'user3'"
WEB = LogExportConfig("web", FieldSet(fields.BASIC.exporters, skip=SKIP), window_ms=DAY,
                      min_level=1)
NO_PAGE = FieldSet((fields.HTTP, fields.INSTANCE, fields.TIMESTAMP, fields.USER, fields.VERSION))

PAGE_NUMBER = Exporter("page", (FieldSpec(
    "pageNumber", "integer", "regexp_extract(resource, '^/[a-z]+/([^/?#]*)', 1)"),))
CHECKED = LogExportConfig("checked", FieldSet((*fields.BASIC.exporters, PAGE_NUMBER)),
                          window_ms=DAY, max_row_bytes=MAX_ROW_BYTES)

DAILY = LogExportConfig("daily", NO_PAGE, window_ms=DAY)

# A record by name, its items and parts to be checked, and numbers that must not lose anything.
NESTED = FieldSet((fields.HTTP, Exporter("nested", (
    FieldSpec("client", "record",
              "named_struct('userAgent', user_agent, 'number', substring(nickname, 5), 'ip', ip)",
              fields=(FieldSpec("ip", "string"), FieldSpec("userAgent", "string"),
                      FieldSpec("number", "integer"))),
    FieldSpec("octets", "integer", "if(event_id % 7 = 0, array('1', 'x'), split(ip, '[.]'))",
              repeated=True),
    FieldSpec("half", "integer", "event_id / 2.0D"),
))))

# Some rows with a value that is no number, some far above the limit.
STREAMED = LogExportConfig("stream", FieldSet((*NO_PAGE.exporters, Exporter("odd", (
    FieldSpec("userNumber", "integer", "substring(nickname, 5)"),
    FieldSpec("padding", "string", "if(event_id % 11 = 0, repeat('x', 1000), '')"),
)))), window_ms=DAY, max_row_bytes=900)

CLIENT = Exporter("client", (
    FieldSpec("client", "record", "named_struct('ip', ip, 'userAgent', user_agent)",
              fields=(FieldSpec("ip", "string"), FieldSpec("userAgent", "string"))),
    FieldSpec("levels", "INTEGER", "transform(app_logs, l -> l.level)", repeated=True),
    FieldSpec("slow", "boolean", "latency_usec > 100000"),
    FieldSpec("firstMessage", "string", "get(app_logs, 0).message", nullable=True),
    FieldSpec("agentNumber", "integer", "agent.number"),
), shared={"agent": "named_struct('number', substring(user_agent, 3))"})
# Names a shared column like another exporter's, and one like an input column.
SIGN = Exporter("sign", (FieldSpec("sign", "string", "concat(agent, '@', ip)"),),
                shared={"agent": "upper(user_agent)", "ip": "left(ip, 4)"})


# Scans.

@query
def scan_log_range(spark, sf):
    found = logs.scan_range(inputs.core_logs(spark, sf), JAN_5, JAN_12, time="event_time")
    return found.select("request_id", "start_time_usec", "http_status", "method", "cost")


@query
def app_log_lines(spark, sf):
    lines = logs.app_log_lines(inputs.core_logs(spark, sf))
    return lines.withColumns({c: F.col(c).cast("bigint") for c in ("line", "level")})


@query
def manifest_range(spark, sf):
    return manifest.log_uris(inputs.manifest(spark, sf), inputs.BUCKET, fields.BASIC.schema_hash(),
                             JAN_5, JAN_12)


@query
def manifest_schemas(spark, sf):
    return manifest.log_uris(inputs.manifest(spark, sf), inputs.BUCKET, inputs.OTHER_HASH,
                             JAN_5, JAN_12, read_schemas=True)


@query
def backup_lookup(spark, sf):
    return backups.find_backup(inputs.backup_info(spark, sf), UNFINISHED_BACKUP, "nightly")


@query
def backup_ready(spark, sf):
    return backups.ready(
        backups.find_backup(inputs.backup_info(spark, sf), FINISHED_BACKUP, "nightly"))


@query
def backup_lookups(spark, sf):
    """The first backup of every prefix in one go."""
    return backups.find_backups(inputs.backup_info(spark, sf), inputs.backup_prefixes(spark, sf))


@query
def kind_uris(spark, sf):
    return backups.kind_uris(inputs.backup_info(spark, sf), list(inputs.KINDS), FINISHED_BACKUP)


def _recorded(spark, sf) -> str:
    """The ledger's folder after a log export and a snapshot load below one root."""
    database, root = _database(spark, "runs")
    found = inputs.core_logs(spark, sf)
    log_export.export_windows(found, DAILY, _windows_of(found, DAY), root)
    config = SnapshotConfig(inputs.KINDS, root, database)
    snapshot_export.start(spark, inputs.entities(spark, sf), config, JAN_5)
    return f"{root}/runs"


@query
def run_list(spark, sf):
    return run_source.list_runs(run_source.read_runs(spark, _recorded(spark, sf)))


@query
def run_lookup(spark, sf):
    return run_source.find_run(spark, _recorded(spark, sf), RUN_ID)


# Field extraction.

@query
def fields_http(spark, sf):
    return rows.export_rows(inputs.core_logs(spark, sf), _group(fields.HTTP))


@query
def fields_instance(spark, sf):
    return rows.export_rows(inputs.core_logs(spark, sf), _group(fields.INSTANCE), ["request_id"])


@query
def fields_performance(spark, sf):
    return rows.export_rows(inputs.request_logs(spark, sf), _group(fields.PERFORMANCE),
                            ["request_id"])


@query
def fields_timestamp(spark, sf):
    return rows.export_rows(inputs.core_logs(spark, sf), _group(fields.TIMESTAMP), ["request_id"])


@query
def fields_url(spark, sf):
    return rows.export_rows(inputs.request_logs(spark, sf), _group(fields.URL), ["request_id"])


@query
def fields_user(spark, sf):
    return rows.export_rows(inputs.core_logs(spark, sf), _group(fields.USER), ["request_id"])


@query
def fields_version(spark, sf):
    return rows.export_rows(inputs.core_logs(spark, sf), _group(fields.VERSION), ["request_id"])


@query
def fields_basic(spark, sf):
    return rows.export_rows(inputs.request_logs(spark, sf), fields.BASIC)


@query
def export_rows(spark, sf):
    return log_export.window_rows(inputs.request_logs(spark, sf), WEB)


@query
def format_values(spark, sf):
    specs = (
        FieldSpec("idText", "string", "event_id"),
        FieldSpec("costText", "string", "cost"),
        FieldSpec("loadingText", "STRING", "loading_request"),
        FieldSpec("startedAt", "integer", "event_time"),
        FieldSpec("startedOn", "integer", "cast(event_time AS date)"),
        FieldSpec("status", "integer", "http_status"),
        FieldSpec("mcyclesFloat", "float", "mcycles"),
        FieldSpec("isSlow", "boolean", "latency_usec > 100000"),
    )
    return rows.export_rows(inputs.core_logs(spark, sf), _group(Exporter("formats", specs)))


@query
def custom_fields(spark, sf):
    found = rows.export_rows(inputs.core_logs(spark, sf), FieldSet((SIGN, CLIENT)),
                             ["request_id"])
    return found.select(
        "request_id", "sign", F.col("client.ip").alias("clientIp"),
        F.col("client.userAgent").alias("clientAgent"),
        F.array_join(F.transform("levels", lambda v: v.cast("string")), ",").alias("levels"),
        "slow", "firstMessage", "agentNumber")


@query
def nested_fields(spark, sf):
    checked = rows.checked_rows(inputs.core_logs(spark, sf), NESTED, None)
    return rows.valid_rows(checked, NESTED).select(
        "requestId", F.col("client.ip").alias("ip"), F.col("client.userAgent").alias("userAgent"),
        F.col("client.number").alias("number"),
        F.array_join(F.transform("octets", lambda v: v.cast("string")), ",").alias("octets"), "half")


@query
def nested_rejects(spark, sf):
    checked = rows.checked_rows(inputs.core_logs(spark, sf), NESTED, None)
    return rows.reject_rows(checked, NESTED).select("request_id", "reason", "message")


# Filters.

@query
def min_level(spark, sf):
    kept = filters.min_level(inputs.core_logs(spark, sf), 3)
    return kept.select("request_id", F.size("app_logs").cast("bigint").alias("line_count"))


@query
def stored_min_level(spark, sf):
    """A level and a span of time asked of stored logs: both are pushed down to row groups."""
    path = session.fresh_dir(spark, "stored_min_level")
    log_store.store(inputs.core_logs(spark, sf).drop("event_time"), path)
    found = logs.scan_range(spark.read.parquet(path), JAN_5, JAN_12, day="day")
    return filters.min_level(found, 3).select("request_id", "start_time_usec")


@query
def version_filter(spark, sf):
    wanted = spark.sql("VALUES ('v0', 'default'), ('v2', 'worker') AS v(version_id, module_id)")
    kept = filters.versions(inputs.core_logs(spark, sf), wanted)
    return kept.select("request_id", "version_id", "module_id")


@query
def skip_predicate(spark, sf):
    kept = filters.skip(inputs.core_logs(spark, sf), SKIP)
    return kept.select("request_id", "http_status", "nickname")


@query
def required_ok(spark, sf):
    both = FieldSet((fields.USER, Exporter("first", (
        FieldSpec("firstMessage", "string", "get(app_logs, 0).message", nullable=True),))))
    return rows.export_rows(inputs.core_logs(spark, sf), both, ["request_id"])


# Windows.

@query
def align_time(spark, sf):
    """Offsets from mid-month, so values on both sides of zero are aligned."""
    offset = F.expr(f"start_time_usec div 1000 - {JAN_1 + 15 * DAY}")
    return inputs.core_logs(spark, sf).select(
        "request_id", offset.alias("offset_ms"), times.align(offset, HOUR).alias("aligned_ms"))


@query
def assign_window(spark, sf):
    found = windows.assign_window(inputs.core_logs(spark, sf), MINUTE)
    return found.select("request_id", "window_start", "window_end")


@query
def plan_windows(spark, sf):
    return windows.plan_windows(inputs.triggers(spark, sf), MINUTE)


@query
def pending_windows(spark, sf):
    return windows.pending_windows(plan_windows(spark, sf), inputs.runs(spark, sf), "web")


@query
def rows_per_window(spark, sf):
    return reports.rows_per_window(windows.assign_window(inputs.core_logs(spark, sf), HOUR))


@query
def on_time_rows(spark, sf):
    kept = windows.on_time(inputs.core_logs(spark, sf), MINUTE)
    return kept.select("request_id", "start_time_usec", "arrival_usec")


@query
def late_rows(spark, sf):
    kept = windows.late(inputs.core_logs(spark, sf), MINUTE)
    return kept.select("request_id", "start_time_usec", "arrival_usec")


# Duplicates, sizes, rejects, batches.

@query
def dedup_insert_id(spark, sf):
    sent = inputs.replays(inputs.core_logs(spark, sf))
    found = dedup.dedup(sent.drop("app_logs", "event_time"), "request_id", ["arrival_usec"])
    return found.select("request_id", "attempt", "arrival_usec", "http_status", "nickname")


@query
def row_bytes(spark, sf):
    found = rows.export_rows(inputs.request_logs(spark, sf), fields.BASIC)
    return found.select("requestId", rows.row_size(found, fields.BASIC).alias("row_bytes"))


def _checked(spark, sf):
    return log_export.checked_window_rows(inputs.request_logs(spark, sf), CHECKED)


@query
def valid_rows(spark, sf):
    return rows.valid_rows(_checked(spark, sf), CHECKED.field_set, keep=["window_start"])


def _rejects(spark, sf):
    return rows.reject_rows(_checked(spark, sf), CHECKED.field_set, keep=["window_start"])


@query
def reject_rows(spark, sf):
    return _rejects(spark, sf).drop("field_lengths")


@query
def reject_reason_counts(spark, sf):
    return reports.reject_reason_counts(_rejects(spark, sf))


@query
def oversize_field_lengths(spark, sf):
    return reports.oversize_field_lengths(_rejects(spark, sf))


@query
def byte_batches(spark, sf):
    return batching.byte_batches(inputs.row_sizes(spark, sf), ["lang"], ["doc_id"], "row_bytes",
                                 DOCUMENT_BATCH_BYTES)


@query
def byte_batch_sizes(spark, sf):
    return batching.batch_sizes(byte_batches(spark, sf), ["lang"], "row_bytes")


@query
def export_batches(spark, sf):
    """The batches of a log export: daily windows in request order, sized as printed rows."""
    found = windows.assign_window(inputs.request_logs(spark, sf), DAY)
    found = rows.export_rows(found, fields.BASIC, keep=["window_start"])
    sized = found.select("window_start", "timestamp", "requestId",
                         rows.row_size(found, fields.BASIC).alias("row_bytes"))
    return batching.byte_batches(sized, ["window_start"], ["timestamp", "requestId"], "row_bytes",
                                 LOG_BATCH_BYTES)


@query
def byte_batches_by_time(spark, sf):
    """Groups one microsecond apart."""
    events = inputs.table(spark, sf, "events").select(
        F.timestamp_micros(F.expr("event_id div 50")).alias("at"), "event_id",
        (F.octet_length("props") + 1).cast("bigint").alias("row_bytes"))
    found = batching.byte_batches(events, ["at"], ["event_id"], "row_bytes", EVENT_BATCH_BYTES)
    return found.select(F.unix_micros("at").alias("at_usec"), "event_id", "row_bytes", "batch")


# Keys, text, schemas.

@query
def log_keys(spark, sf):
    parts = (F.col("schema_hash"), F.col("start_ms"), F.col("end_ms"))
    return inputs.minute_windows(spark, sf).select(
        keys.log_key(*parts).alias("log_key"), keys.schema_key(*parts).alias("schema_key"))


@query
def key_end_ms(spark, sf):
    """Data keys, some with trailing separators."""
    found = manifest.data_or_schema(inputs.manifest(spark, sf), read_schemas=False)
    key = F.concat("key", F.repeat(F.lit("_"), F.length("key") % 2 + F.ascii(
        F.substring("key", 5, 1)) % 2)).alias("key")
    return found.select(key).select("key", keys.key_end_ms(F.col("key")).alias("end_ms"))


@query
def csv_lines(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    line = row_text.csv_line([F.col(c) for c in ("doc_id", "lang", "source", "text")])
    return docs.select("doc_id", line.alias("line"))


@query
def schema_hash(spark, sf):
    return inputs.field_sets(spark, sf).select(
        "set_name", schemas.schema_hash(F.col("fields")).alias("schema_hash"))


@query
def duplicate_fields(spark, sf):
    return schemas.duplicate_fields(inputs.field_sets(spark, sf))


@query
def schema_fields(spark, sf):
    return schemas.table_fields(inputs.field_sets(spark, sf))


# Tables. Each call writes below a folder of its own and returns what it reads back.

def _windows_of(found: DataFrame, window_ms: int, time: str = "start_time_usec") -> DataFrame:
    """The planner's windows from the first to the last that has logs."""
    first, last = windows.assign_window(found, window_ms, time).agg(
        F.min("window_start"), F.max("window_start")).first()
    return windows.plan_windows(windows.trigger_at(found.sparkSession, first + window_ms),
                                window_ms, count=(last - first) // window_ms + 1)


@query
def export_table(spark, sf):
    """The whole log export over replayed logs: select, extract, dedup, write, ledger; run twice."""
    root = session.fresh_dir(spark, "export_table")
    found = inputs.request_logs(spark, sf)
    for _ in range(2):
        log_export.export_windows(inputs.replays(found), WEB, _windows_of(
            inputs.core_logs(spark, sf), DAY), root, time="event_time")
    return tables.read_rows(spark, root, WEB)


@query
def export_ledger(spark, sf):
    """Ledger of an export that sets rows aside."""
    root = session.fresh_dir(spark, "export_ledger")
    log_export.export_windows(inputs.request_logs(spark, sf), CHECKED, _windows_of(
        inputs.core_logs(spark, sf), DAY), root, time="event_time")
    return run_source.list_runs(run_source.read_runs(spark, f"{root}/runs"))


def _exported(spark, root: str, config: LogExportConfig) -> DataFrame:
    return tables.read_rows(spark, root, config).select("window_start", "requestId")


@query
def export_gaps(spark, sf):
    """Every other window, each asked for twice, and no other is exported."""
    root = session.fresh_dir(spark, "export_gaps")
    found = inputs.core_logs(spark, sf)
    some = _windows_of(found, DAY).where(F.col("window_start") / DAY % 2 == 0)
    log_export.export_windows(found, DAILY, some.unionAll(some), root)
    return _exported(spark, root, DAILY)


@query
def export_other_time(spark, sf):
    """Windows by arrival, in two runs: the second leaves the windows of the first alone."""
    root = session.fresh_dir(spark, "export_other_time")
    found = inputs.core_logs(spark, sf)
    planned = _windows_of(found, DAY, "arrival_usec")
    for part in (planned.where(F.col("window_start") / DAY % 3 == 0), planned):
        log_export.export_windows(found, DAILY, part, root, time="arrival_usec")
    return _exported(spark, root, DAILY)


@query
def export_rerun(spark, sf):
    """An attempt that wrote more rows but was not finished leaves none behind."""
    root = session.fresh_dir(spark, "export_rerun")
    found = inputs.core_logs(spark, sf)
    tables.write_attempt(log_export.outcomes(found, DAILY), DAILY, root, "interrupted",
                         "requestId", 1)
    fewer = LogExportConfig("daily", FieldSet(NO_PAGE.exporters, skip=SKIP), window_ms=DAY)
    log_export.export_windows(found, fewer, _windows_of(found, DAY), root)
    return _exported(spark, root, DAILY)


@query
def export_concurrent(spark, sf):
    """Three runs of the same windows at the same time; every row is there once."""
    root = session.fresh_dir(spark, "export_concurrent")
    found = inputs.core_logs(spark, sf)
    planned = _windows_of(found, DAY)
    with ThreadPoolExecutor(3) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(log_export.export_windows), found,
                               DAILY, planned, root) for _ in range(3)]
        for run in started:
            run.result()
    return _exported(spark, root, DAILY)


@query
def export_takeover(spark, sf):
    """One run holds every third window, another has died over every third: the export does all but
    what is held, and the dead one, alive after all, publishes nothing."""
    root = session.fresh_dir(spark, "export_takeover")
    found = inputs.core_logs(spark, sf)
    planned = _windows_of(found, DAY)
    days = [r[0] for r in planned.select("window_start").collect()]
    other = journal.Journal(spark, f"{root}/runs", DAILY.name)
    other.claim([w for w in days if w // DAY % 3 == 0], "alive")
    dead = other.claim([w for w in days if w // DAY % 3 == 1], "dead", hold_ms=-1)
    log_export.export_windows(found, DAILY, planned, root)
    other.publish("dead", [journal.run_of(DAILY.name, w, DAY, row_count=1) for w in dead])
    return _exported(spark, root, DAILY)


LOOSE = LogExportConfig("loose", FieldSet((fields.TIMESTAMP, Exporter("id", (
    FieldSpec("requestId", "string", "request_id", nullable=True),)))), window_ms=DAY)


@query
def export_null_ids(spark, sf):
    """Replayed logs of which the odd ones have no insert id: those all stay."""
    root = session.fresh_dir(spark, "export_null_ids")
    sent = inputs.replays(inputs.core_logs(spark, sf)).withColumn(
        "request_id", F.when(F.col("event_id") % 2 == 0, F.col("request_id")))
    log_export.export_windows(sent, LOOSE, _windows_of(inputs.core_logs(spark, sf), DAY), root)
    return tables.read_rows(spark, root, LOOSE).select("window_start", "timestamp", "requestId")


@query
def export_vacuum(spark, sf):
    """The folder of a killed attempt goes, published rows stay."""
    root = session.fresh_dir(spark, "export_vacuum")
    found = inputs.core_logs(spark, sf)
    tables.write_attempt(log_export.outcomes(found, DAILY), DAILY, root, "killed", "requestId", 1)
    log_export.export_windows(found, DAILY, _windows_of(found, DAY), root)
    gone = vacuum.attempts(spark, root, DAILY, grace_ms=0)
    left = tables.read_rows(spark, root, DAILY).groupBy("window_start").agg(
        F.count("*").alias("row_count"))
    return left.withColumn("removed", F.lit(len(gone)).cast("bigint"))


@query
def ledger_compacted(spark, sf):
    """A record per hour that has logs: beyond some records they are in a checkpoint."""
    root = session.fresh_dir(spark, "ledger_compacted")
    hours = rows_per_window(spark, sf).collect()
    log = journal.Journal(spark, f"{root}/runs", "hourly")
    for part in range(48):
        log.append(f"part-{part}", [
            journal.run_of("hourly", r["window_start"], HOUR, row_count=r["row_count"])
            for r in hours if r["window_start"] // HOUR % 48 == part])
    return run_source.list_runs(run_source.read_runs(spark, f"{root}/runs"))


@query
def route_tables(spark, sf):
    """Rows routed to a table per day."""
    root = session.fresh_dir(spark, "route_tables")
    daily = LogExportConfig(
        "daily", NO_PAGE, window_ms=DAY,
        table_id=lambda start: F.date_format(F.timestamp_millis(start), "yyyyMMdd"))
    tables.write_windows(log_export.window_rows(inputs.core_logs(spark, sf), daily), daily, root)
    return tables.read_windows(spark, root, NO_PAGE.schema()).select(
        "table_id", "window_start", "requestId")


def _database(spark, label: str) -> tuple[str, str]:
    root = session.fresh_dir(spark, label)
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}'")
    return name, root


@query
def create_tables(spark, sf):
    """Create a table for every month of logs that go on for some months, and fill them, twice;
    every row is there once."""
    database, root = _database(spark, "create_tables")
    monthly = LogExportConfig("monthly", NO_PAGE, window_ms=DAY)
    found = inputs.core_logs(spark, sf).withColumn(
        "start_time_usec", F.expr(f"{JAN_1 * 1000} + (start_time_usec - {JAN_1 * 1000}) * 4"))
    exported = log_export.window_rows(found, monthly)
    months = exported.select(F.trunc(F.timestamp_millis("window_start").cast("date"), "month")
                             .alias("month")).distinct().collect()
    for _ in range(2):
        ids = set()
        for row in months:
            at = int(datetime(row["month"].year, row["month"].month, 1, tzinfo=UTC).timestamp())
            ids |= set(tables.create_window_tables(spark, monthly, database, root,
                                                   at * 1000 + DAY))
        tables.insert_windows(exported, monthly, database, root, sorted(ids))
    return reduce(DataFrame.unionByName, [
        spark.table(tables.table_name(monthly, database, i)).select(F.lit(i).alias("table_id"), "*")
        for i in sorted(ids)])


def _snapshot_config(spark, label: str, append_timestamp: bool) -> SnapshotConfig:
    database, root = _database(spark, label)
    return SnapshotConfig(inputs.KINDS, root, database, append_timestamp, name_prefix="nightly")


def _entity_rows(spark, names: dict[str, str]) -> DataFrame:
    """Rows of the kinds' tables in one shape."""
    shape = {"customer": ("c_custkey", "c_name", "c_acctbal"),
             "supplier": ("s_suppkey", "s_name", "s_acctbal"),
             "part": ("p_partkey", "p_name", "p_retailprice")}
    found = [spark.table(names[kind]).select(
        F.lit(names[kind].split(".")[1]).alias("table_name"), F.col(key).alias("entity_key"),
        F.col(name).alias("entity_name"), F.col(amount).alias("amount"))
        for kind, (key, name, amount) in shape.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def snapshot_backup(spark, sf):
    """Back up without loading; rows per kind found under the handle in the catalogue."""
    root = session.fresh_dir(spark, "snapshot_backup")
    config = SnapshotConfig(inputs.KINDS, root, skip_load=True)
    snapshot_export.start(spark, inputs.entities(spark, sf), config, JAN_1)
    handle = backups.find_backup(
        snapshots.read_catalogue(spark, config), JAN_1, None).first().gs_handle
    counts = [backups.read_kind(spark, handle, kind).agg(F.count("*").alias("row_count"))
              .select(F.lit(kind).alias("kind"), "row_count") for kind in inputs.KINDS]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def snapshot_read(spark, sf):
    """One kind's files of a finished backup."""
    root = session.fresh_dir(spark, "snapshot_read")
    config = SnapshotConfig(inputs.KINDS, root, skip_load=True)
    handle = snapshots.back_up(spark, inputs.entities(spark, sf), config, JAN_1)
    return backups.read_kind(spark, handle, "customer")


@query
def snapshot_replace(spark, sf):
    """Two snapshots into the same tables; the second one stays."""
    config = _snapshot_config(spark, "snapshot_replace", append_timestamp=False)
    found = inputs.entities(spark, sf)
    renamed = found["part"].withColumn("p_name", F.upper("p_name"))
    snapshot_export.start(spark, {**found, "part": renamed}, config, JAN_1)
    snapshot_export.start(spark, found, config, JAN_5)
    return _entity_rows(spark, {k: f"{config.database}.{k}" for k in config.kinds})


@query
def snapshot_history(spark, sf):
    """Two snapshots side by side, in tables named by their timestamp."""
    config = _snapshot_config(spark, "snapshot_history", append_timestamp=True)
    found = inputs.entities(spark, sf)
    for at in (JAN_1, JAN_5):
        snapshot_export.start(spark, found, config, at)
    first, second = (_entity_rows(spark, {k: f"{config.database}.{keys.kind_table(k, at)}"
                                          for k in config.kinds}) for at in (JAN_1, JAN_5))
    return first.unionByName(second)


# Streams, run to the end of their input.

ONCE = {"availableNow": True}


@query
def stream_dedup(spark, sf):
    root = session.fresh_dir(spark, "stream_dedup")
    sent = inputs.replays(inputs.log_stream(spark, sf))
    kept = stream.drop_replays(sent).select("request_id", "start_time_usec", "http_status", "ip")
    stream.start_append(kept, f"{root}/rows", f"{root}/checkpoint", ONCE).awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{root}/rows")


def _streamed(spark, sf, root: str) -> None:
    sent = stream.drop_replays(inputs.replays(inputs.log_stream(spark, sf)))
    stream.start_export(sent, STREAMED, root, f"{root}/checkpoint", ONCE).awaitTermination()


@query
def stream_export(spark, sf):
    """Replayed logs with bad and over-size values, as a stream; the good rows."""
    root = session.fresh_dir(spark, "stream_export")
    _streamed(spark, sf, root)
    return tables.read_rows(spark, root, STREAMED).drop("padding")


@query
def stream_rejects(spark, sf):
    """What the same stream sets aside."""
    root = session.fresh_dir(spark, "stream_rejects")
    _streamed(spark, sf, root)
    return tables.read_rejects(spark, root, STREAMED).select(
        "window_start", "request_id", "reason", "message")


def _part_by_part(rows: DataFrame, part: Column, parts: int, root: str,
                  start: Callable[[DataFrame], StreamingQuery]) -> DataFrame:
    """`rows` sent as a stream, a part to a micro-batch: every task writes a file of what it has read of
    a part, and the stream takes these up, from where it was, before the next part is sent."""
    for i in range(parts):
        rows.where(part == i).write.mode("append").parquet(f"{root}/sent")
        sent = stream.read_stream(rows.sparkSession, f"{root}/sent", rows.schema)
        start(sent).awaitTermination()
    return sent


def _closed(spark, sf, label: str, parts: int = 4) -> tuple[str, DataFrame]:
    """The core logs as a stream in order of arrival."""
    root = session.fresh_dir(spark, label)
    found = inputs.core_logs(spark, sf).drop("event_time")
    first, last = found.agg(F.min("arrival_usec"), F.max("arrival_usec")).first()
    part = F.least(F.lit(parts - 1), F.floor(
        (F.col("arrival_usec") - first) * parts / (last - first + 1))).cast("int")
    return root, _part_by_part(found, part, parts, root, lambda sent: closing.start_export(
        sent, DAILY, root, f"{root}/checkpoint", ONCE))


@query
def stream_windows(spark, sf):
    """The ledger of a stream in several micro-batches: one finished run for each closed window."""
    root, _ = _closed(spark, sf, "stream_windows")
    runs = run_source.read_runs(spark, f"{root}/runs", DAILY.name)
    return runs.where("status = 'done'").select("run_id", "window_start", "row_count")


@query
def stream_closed_rows(spark, sf):
    """The rows of closed windows, written by several micro-batches."""
    root, _ = _closed(spark, sf, "stream_closed_rows")
    return _exported(spark, root, DAILY)


@query
def stream_late(spark, sf):
    """Late rows of the same stream."""
    root, sent = _closed(spark, sf, "stream_late")
    return closing.read_late(spark, root, DAILY, sent.schema).select(
        "request_id", "window_start", "late_by_ms", "reason")


@query
def stream_batches(spark, sf):
    """Greedy batches of documents that come in four micro-batches, equal to those of the whole."""
    root = session.fresh_dir(spark, "stream_batches")
    sized = inputs.row_sizes(spark, sf)
    first, last = sized.agg(F.min("doc_id"), F.max("doc_id")).first()
    part = F.floor((F.col("doc_id") - first) * 4 / (last - first + 1))
    _part_by_part(sized, part, 4, root, lambda sent: batches.start_batches(
        sent, f"{root}/out", f"{root}/checkpoint", ["lang"], ["doc_id"], "row_bytes",
        DOCUMENT_BATCH_BYTES, ONCE))
    return batches.read_batches(spark, f"{root}/out", sized.schema)
