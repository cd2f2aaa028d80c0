"""Inputs of the registered queries, derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.functions import keys, times
from logtables.operators.fields import BASIC
from logtables.sinks.tables import run_rows
from logtables.streaming.export import read_stream

KINDS = ("customer", "supplier", "part")
BUCKET = "exports"
OTHER_HASH = "0a1b2c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log_columns(events: DataFrame) -> DataFrame:
    """Columns of a request that come from its event alone. `event_time` stays the stored column."""
    start = "unix_micros(cast(ts AS timestamp))"
    return events.selectExpr(
        "event_id",
        "cast(event_id AS string) AS request_id",
        "ts AS event_time",
        f"{start} AS start_time_usec",
        f"{start} + event_id * 7 % 180 * 1000000 AS arrival_usec",
        "CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 201 ELSE 200 END AS http_status",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method",
        "'HTTP/1.1' AS http_version",
        "concat('i', user_id % 7) AS instance_key",
        "value AS cost",
        "event_id % 1000 AS mcycles",
        "event_id % 100 = 0 AS loading_request",
        "event_id % 13 * 1000 AS pending_time_usec",
        "cast(round(value * 1000) AS bigint) AS latency_usec",
        "CASE WHEN user_id % 5 = 0 THEN '' ELSE concat('user', user_id) END AS nickname",
        "concat('10.0.', user_id % 256, '.', event_id % 256) AS ip",
        "concat('ua', user_id % 11) AS user_agent",
        "concat('v', user_id % 3) AS version_id",
        "CASE WHEN event_id % 2 = 0 THEN 'default' ELSE 'worker' END AS module_id",
        """slice(array(
            named_struct('level', cast(event_id % 5 AS int), 'message', event_type),
            named_struct('level', cast(event_id * 3 % 5 AS int), 'message', props)),
            1, cast(event_id % 3 AS int)) AS app_logs""")


def core_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request logs without the URL and response size: a plain projection of `events`."""
    return _log_columns(table(spark, sf_dir, "events"))


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request logs with URL and response size from the page of each request.

    Pages shrink to three short columns before the join, so their HTML is never shuffled. The
    outer join keeps every request and leaves only the pages as a side Spark may broadcast, if they
    are small.
    """
    pages = table(spark, sf_dir, "pages")
    page_count = pages.agg(F.count("*")).scalar()
    page = pages.selectExpr(
        "page_id",
        "regexp_extract(url, '^https?://([^/]+)', 1) AS host",
        "regexp_extract(url, '^https?://[^/]+(.*)$', 1) AS resource",
        "cast(length(html) AS bigint) AS response_size")
    logs = core_logs(spark, sf_dir).withColumn("page_id", F.col("event_id") % page_count)
    return logs.join(page, "page_id", "left").drop("page_id")


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The core logs as a stream, event time with a zone as watermarks ask for."""
    schema = table(spark, sf_dir, "events").schema
    events = read_stream(spark, sf_dir, schema, name_pattern="events.parquet")
    return _log_columns(events).withColumn("event_time", F.timestamp_micros("start_time_usec"))


def replays(logs: DataFrame) -> DataFrame:
    """Every request sent one to three times, each attempt arriving a second after the last."""
    attempt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 3)).alias("attempt")
    return (logs.select("*", attempt)
            .withColumn("arrival_usec", F.col("arrival_usec") + F.col("attempt") * 1_000_000))


def row_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", (F.octet_length("text") + 1).cast("bigint").alias("row_bytes"))


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event counts as a call of the planner."""
    return table(spark, sf_dir, "events").select(times.millis(F.col("ts")).alias("now_ms"))


def runs(spark: SparkSession, sf_dir: str, window_ms: int = 60_000) -> DataFrame:
    """A ledger: one run per minute that has events, some failed, some of another configuration."""
    start = times.window_start_ms(times.usec(F.col("ts")), window_ms).alias("window_start")
    counts = table(spark, sf_dir, "events").groupBy(start).agg(F.count("*").alias("row_count"))
    minute = F.call_function("div", F.col("window_start"), F.lit(window_ms))
    done = run_rows(counts, "web", window_ms)
    return (done.withColumns({
        "config": F.when(minute % 7 == 0, "jobs").otherwise("web"),
        "status": F.when(minute % 5 == 0, "failed").otherwise("done")})
        .withColumn("run_id", F.concat_ws("_", "config", "window_start", "window_end")))


def backup_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backup per order: unfinished ones, several under one name, names above the range."""
    at = times.millis(F.col("o_orderdate"))
    day = F.date_format("o_orderdate", "yyyy_MM_dd")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("nightly"), at, F.lit("_"),
                 F.when(F.col("o_orderstatus") == "F", "x").otherwise(""), day,
                 F.lit("_"), F.col("o_orderkey")).alias("name"),
        F.when(F.col("o_orderkey") % 3 != 0, at + 300_000).alias("complete_time"),
        F.when(F.col("o_orderpriority") != "5-LOW",
               F.concat(F.lit("/gs/bucket/gs/"), "o_orderkey", F.lit(".backup_info")))
        .alias("gs_handle"))


def backup_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each day of an order: its backup's name as expected, with and without what finished orders
    add, a short form that covers several days, and one that lies behind all names of the day."""
    at = times.millis(F.col("o_orderdate")).cast("string")
    expected = F.concat(F.lit("nightly"), at, F.lit("_"))
    forms = F.array(expected, F.concat(expected, F.lit("x")), F.substring(expected, 1, 11),
                    F.concat(expected, F.lit("~")))
    return table(spark, sf_dir, "orders").select(F.explode(forms).alias("prefix"))


def entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {kind: table(spark, sf_dir, kind) for kind in KINDS}


def minute_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minutes that have events, for two schema hashes."""
    start = times.window_start_ms(times.usec(F.col("ts")), 60_000).alias("start_ms")
    hashes = F.explode(F.array(F.lit(BASIC.schema_hash()), F.lit(OTHER_HASH))).alias("schema_hash")
    return (table(spark, sf_dir, "events").select(start).distinct()
            .select("start_ms", (F.col("start_ms") + 60_000).alias("end_ms"), hashes))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data key and a schema key per window and hash."""
    parts = ("schema_hash", "start_ms", "end_ms")
    both = F.array(keys.log_key(*map(F.col, parts)), keys.schema_key(*map(F.col, parts)))
    return minute_windows(spark, sf_dir).select(F.explode(both).alias("key"))


def field_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field set per customer: the default fields, some in upper-case types, and one of its own
    that clashes with `path` in one market segment."""
    own_name = "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'path' ELSE lower(c_mktsegment) END"
    fields = [(f"'{f.name}'", f"if(c_nationkey % 3 = 0, '{f.type.upper()}', '{f.type}')", "false")
              for f in BASIC.fields] + [(own_name, "'string'", "c_nationkey % 2 = 0")]
    listed = ", ".join(
        f"named_struct('ord', {i}L, 'name', {name}, 'type', {type_}, 'repeated', {repeated})"
        for i, (name, type_, repeated) in enumerate(fields))
    return table(spark, sf_dir, "customer").selectExpr(
        "c_name AS set_name", f"array({listed}) AS fields")

