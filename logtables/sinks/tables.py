"""Window tables: writing, creating and routing them, attempts of exports, and the run ledger."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.functions.rows import literal
from logtables.operators import batching, combine
from logtables.operators.rows import REJECTS, ROWS
from logtables.session import list_dir
from logtables.sources.runs import DONE, WRITTEN, read_runs
from logtables.spec import LogExportConfig

LAYOUT = T.StructType([T.StructField("table_id", T.StringType()),
                       T.StructField("window_start", T.LongType())])


def route(rows: DataFrame, config: LogExportConfig) -> DataFrame:
    """Add the table a row belongs to, a function of its window."""
    return rows.withColumn("table_id", config.table_id(F.col("window_start")))


#: Bytes of an attempt's rows to a task, by the planner's estimates. Rows of a log that are held to be
#: sorted take about a dozen times that.
TASK_BYTES = 16 << 20


def tasks_of(rows: DataFrame) -> int | None:
    """Tasks to write rows with, by their size; none for what a task for each core holds."""
    size, _ = batching.estimated_size(rows._jdf.queryExecution().optimizedPlan())
    tasks = -(-size // TASK_BYTES)
    return tasks if tasks > rows.sparkSession.sparkContext.defaultParallelism else None


def spread_of(spark: SparkSession, partitions: int | None = None, tasks: int | None = None) -> int:
    """Tasks to deal a partition over: by default four times its share of all shuffle partitions, or
    of `tasks` if these are more, so that one which is several times the average still spreads."""
    tasks = max(tasks or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, -(-4 * tasks // partitions)) if partitions else tasks


def _spread(rows: DataFrame, by: Sequence[str], spread: int | None) -> DataFrame:
    """Bring the rows of a partition together without sending a large one to a single task.

    Adaptive execution splits large and joins small partitions by their measured size. Where it is
    off, as in stateful streams, every partition is dealt over `spread` tasks.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", *by)
    # Dealt by content, so a task that runs again sends every row to the same place.
    content = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    tasks = spread or spread_of(rows.sparkSession)
    return rows.repartition(*by, F.pmod(F.xxhash64(*content), F.lit(tasks)))


def write_partitions(rows: DataFrame, path: str, by: Sequence[str], spread: int | None = None
                     ) -> None:
    """Replace exactly the partitions present in `rows`, so a re-run leaves one copy."""
    (_spread(rows, by, spread).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def write_windows(rows: DataFrame, config: LogExportConfig, path: str) -> None:
    write_partitions(route(rows, config), path, LAYOUT.names)


def read_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a window table by its known schema: no inference, partitions pruned by window."""
    return spark.read.schema(T.StructType([*schema.fields, *LAYOUT.fields])).parquet(path)


def table_ids(spark: SparkSession, config: LogExportConfig, window_start: int) -> tuple[str, str]:
    """Current and next table for a window."""
    start = F.lit(window_start).cast("bigint")
    row = spark.range(1).select(config.table_id(start), config.next_table_id(start)).first()
    return row[0], row[1]


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Equal names and types in order, ignoring nullability."""
    def plain(t: T.DataType):
        if isinstance(t, T.StructType):
            return [(f.name, plain(f.dataType)) for f in t.fields]
        return [plain(t.elementType)] if isinstance(t, T.ArrayType) else t.simpleString()
    return plain(a) == plain(b)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """Create a Parquet table of windows unless it exists; an existing one must have the same
    columns."""
    schema = T.StructType([*schema.fields, LAYOUT["window_start"]])
    if spark.catalog.tableExists(name):
        if not _same_columns(spark.table(name).schema, schema):
            raise ValueError(f"table {name} exists with other columns")
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY (window_start) LOCATION {literal(path)}")


def quoted(*names: str) -> str:
    """A name for SQL, each part between backticks."""
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def table_name(config: LogExportConfig, database: str, table_id: str) -> str:
    return quoted(database, f"{config.name}_{table_id}")


def create_window_tables(spark: SparkSession, config: LogExportConfig, database: str, root: str,
                         now_ms: int) -> tuple[str, str]:
    """Create the table of the last complete window and the one after it; returns their ids."""
    start = now_ms // config.window_ms * config.window_ms - config.window_ms
    ids = table_ids(spark, config, start)
    for table_id in ids:
        create_table(spark, table_name(config, database, table_id), config.field_set.schema(),
                     f"{root}/table_id={table_id}")
    return ids


def insert_windows(rows: DataFrame, config: LogExportConfig, database: str, root: str,
                   ids: Sequence[str]) -> None:
    """Write rows to a folder of this insert, in one pass for all tables, then point their windows
    there. A row that belongs to none of the tables `ids` fails the insert, and nothing of a
    failed insert is registered."""
    spark = rows.sparkSession
    listed = ", ".join(literal(i) for i in ids)
    checked = route(rows, config).withColumn("table_id", F.expr(
        f"if(table_id IN ({listed}), table_id, "
        "raise_error(concat('no table was created for ', coalesce(table_id, 'null'))))"))
    path = f"{root}/inserts/{uuid.uuid4().hex}"
    write_partitions(checked, path, LAYOUT.names)
    # This insert's folder only; its windows are few beside the rows.
    written = spark.read.schema(LAYOUT).parquet(path).select(*LAYOUT.names).distinct().collect()
    for table_id in ids:
        mine = sorted(r["window_start"] for r in written if r["table_id"] == table_id)
        point_partitions(spark, table_name(config, database, table_id),
                         {w: f"{path}/table_id={table_id}/window_start={w}" for w in mine})


#: Partitions that one statement names.
NAMED = 1000


def point_partitions(spark: SparkSession, name: str, folders: Mapping[int, str]) -> None:
    """Let windows of a table show what is in their folders: new ones with one statement for NAMED of
    them, those that are there already one by one, so none is missing in between."""
    if not folders:
        return
    there = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = [w for w in folders if w not in there]
    for begin in range(0, len(new), NAMED):
        named = " ".join(f"PARTITION (window_start={w}) LOCATION {literal(folders[w])}"
                         for w in new[begin:begin + NAMED])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {named}")
    for w in folders.keys() & there:
        spark.sql(f"ALTER TABLE {name} PARTITION (window_start={w}) "
                  f"SET LOCATION {literal(folders[w])}")
    spark.catalog.refreshTable(name)


OUTCOMES = T.StructType([T.StructField("attempt", T.StringType()),
                         T.StructField("outcome", T.StringType()), *LAYOUT.fields])
REJECT_FIELDS = T.StructType([
    T.StructField("_request_id", T.StringType()), T.StructField("_path", T.StringType()),
    T.StructField("_row_bytes", T.LongType()), T.StructField("_reason", T.StringType()),
    T.StructField("_message", T.StringType()),
    T.StructField("_field_lengths", T.MapType(T.StringType(), T.LongType()))])


#: Up to so many windows are counted while they are written.
OBSERVED = 200


def data_path(root: str, config: LogExportConfig, attempt: str) -> str:
    return f"{root}/{config.name}/data/attempt={attempt}"


def write_attempt(found: DataFrame, config: LogExportConfig, root: str, attempt: str,
                  insert_id: str | None, spread: int, windows: Sequence[int] | None = None,
                  merge_copies: bool = False) -> dict[int, dict]:
    """Write good rows and rejects of one attempt in one pass, one per insert id and window (a reject
    also per message), and return what was written by window: row_count, reject_count, table_id.

    One exchange, by window and a bucket of the id, serves both the removal of copies and the
    files; large attempts have tasks by their size (`tasks_of`). Of copies, the one with the smallest hash of its columns stays, whatever the tasks. Rows
    without an id are nobody's copies: all of them stay, dealt by their content. The windows in
    `windows` are counted by the write itself, if they are no more than OBSERVED; else, or if they are
    not known, the partitions written are counted.

    Copies of an id meet in one task. `merge_copies` is for logs in which one id is sent over and over:
    those that meet in a batch of the input are merged there first, by the same rule, at the price of
    passing all columns through Python.
    """
    content = [f.name for f in found.schema.fields if not isinstance(f.dataType, T.MapType)]
    rejects, tasks = "_reason" in found.columns, tasks_of(found)
    id_ = F.lit(None).cast("string")
    if insert_id is not None:
        own = F.col(f"`{insert_id}`").cast("string")
        id_ = F.coalesce(own, F.col("_request_id")) if rejects else own
    named = ["window_start", "_id", *["outcome", "_message"] * rejects]
    if merge_copies and insert_id is not None:
        hashed = found.withColumns({"_id": id_, "_hash": F.xxhash64(*content)})
        found = hashed.mapInArrow(combine.least_copies(
            ["_id", *[c for c in named if c != "_id"]], "_hash", ["_id", "_hash"]), found.schema)
    placed = (route(found, config).withColumn("_id", id_)
              .withColumn("_bucket", F.pmod(F.when(F.col("_id").isNull(), F.xxhash64(*content))
                                            .otherwise(F.xxhash64("_id")), F.lit(spread)))
              .repartition(*[tasks] * bool(tasks), "window_start", "_bucket"))
    if insert_id is not None:
        copies = Window.partitionBy("_bucket", *named)
        placed = placed.withColumn("_copy", F.row_number().over(
            copies.orderBy(F.xxhash64(*content)))).where("_copy = 1 OR _id IS NULL").drop("_copy")
    path, spark = data_path(root, config, attempt), found.sparkSession
    counted = None
    if windows is not None and 0 < len(windows) <= OBSERVED:
        counted = Observation()
        placed = placed.observe(counted, *[F.count_if(
            (F.col("window_start") == w) & (F.col("outcome") == outcome)).alias(f"{outcome}_{w}")
            for w in windows for outcome in (ROWS, REJECTS)])
    (placed.drop("_id", "_bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "static")
     .partitionBy("outcome", *LAYOUT.names).parquet(path))
    if counted is not None:
        numbers = {tuple(k.rsplit("_", 1)): n for k, n in counted.get.items()}
        counts = [(o, int(w), n) for (o, w), n in numbers.items() if n]
    else:
        files = [f"{path}/{n}" for n in list_dir(spark, path) if n.startswith("outcome=")]
        counts = [] if not files else [tuple(r) for r in spark.read.schema(T.StructType(
            OUTCOMES.fields[1:])).option("basePath", path).parquet(*files).groupBy(
                "outcome", "window_start").agg(F.count("*")).collect()]
    ids = table_ids_of(spark, config, sorted({w for _, w, _ in counts}))
    out = {w: {"row_count": 0, "reject_count": 0, "table_id": t} for w, t in ids.items()}
    for outcome, w, n in counts:
        out[w]["row_count" if outcome == ROWS else "reject_count"] = n
    return out


def table_ids_of(spark: SparkSession, config: LogExportConfig, windows: Sequence[int]
                 ) -> dict[int, str]:
    """The table of each window."""
    starts = spark.createDataFrame([(w,) for w in windows], "w bigint")
    return {r[0]: r[1] for r in starts.select("w", config.table_id(F.col("w"))).collect()}


def published_paths(runs: DataFrame, root: str, config: LogExportConfig, outcome: str,
                    whole: bool) -> list[str]:
    """The folders of finished runs that have rows of an outcome. An attempt that is published whole
    is one folder, if all its windows are wanted (`whole`), otherwise each window is one.

    A finished run without a place is a window that a stream has closed: its rows are where the
    stream has written them, batch by batch.
    """
    count = "row_count" if outcome == ROWS else "reject_count"
    done = runs.where(F.col("status") == DONE)
    closed = done.where("location IS NULL").select("window_start").distinct().withColumn(
        "closed", F.lit(True))
    parts = runs.where(F.col("status") == WRITTEN).join(closed, "window_start", "left").withColumn(
        "whole", F.count_if(F.col("closed").isNull()).over(Window.partitionBy("location")) == 0)
    some = done.where("location IS NOT NULL").select("location", "table_id", "window_start", count,
                                                     "whole").unionAll(
        parts.where("closed").select("location", "table_id", "window_start", count, "whole"))
    entire = F.col("whole") if whole else F.lit(False)
    found = some.where(F.col(count) > 0).select("location", *[
        F.when(~entire, F.col(c)).alias(c) for c in ("table_id", "window_start")]).distinct()
    return sorted(f"{data_path(root, config, r['location'])}/outcome={outcome}" + (
        "" if r["window_start"] is None else
        f"/table_id={r['table_id']}/window_start={r['window_start']}") for r in found.collect())


def read_outcome(spark: SparkSession, root: str, config: LogExportConfig, outcome: str,
                 columns: T.StructType, span: tuple[int, int] | None = None) -> DataFrame:
    """What finished runs have written, with `table_id` and `window_start`, of the windows that start
    in a span if given.

    The read is planned from the ledger. Only folders it names are listed and opened: neither those
    of other attempts, of which there may be any number, nor those of other windows.
    """
    schema = T.StructType([*columns.fields, *LAYOUT.fields])
    runs = read_runs(spark, f"{root}/runs", config.name, span)
    paths = published_paths(runs, root, config, outcome, span is None)
    if not paths:
        return spark.createDataFrame([], schema)
    inside = T.StructType([*columns.fields, *OUTCOMES.fields])
    return spark.read.schema(inside).option("basePath", f"{root}/{config.name}/data").parquet(
        *paths).select(*schema.names)


def read_rows(spark: SparkSession, root: str, config: LogExportConfig,
              span: tuple[int, int] | None = None) -> DataFrame:
    return read_outcome(spark, root, config, ROWS, config.field_set.schema(), span)


def read_rejects(spark: SparkSession, root: str, config: LogExportConfig,
                 span: tuple[int, int] | None = None) -> DataFrame:
    found = read_outcome(spark, root, config, REJECTS, REJECT_FIELDS, span)
    return found.select("window_start", *[F.col(n).alias(n[1:]) for n in REJECT_FIELDS.names])


def run_rows(counts: DataFrame, config: str, window_ms: int, status: str = DONE) -> DataFrame:
    """Ledger rows for windows."""
    end = F.col("window_start") + window_ms
    return counts.select(
        F.concat_ws("_", F.lit(config), "window_start", end).alias("run_id"),
        F.lit(config).alias("config"), "window_start", end.alias("window_end"),
        F.col("row_count").cast("bigint").alias("row_count"), F.lit(status).alias("status"))
