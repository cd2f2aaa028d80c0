"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings a session may change at run time. The rest (executor sizes, shuffle partitions) belongs
# to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method above this size. Wide projections exceed it as one fused
    # stage; below the limit Spark splits them into methods that do get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Arrow functions get batches by size too: a row of slice summaries may be large.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the library relies on (UTC above all)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there; nothing is listed."""
    return _fs(spark, path).exists(_hadoop_path(spark, path))


def delete_dir(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_hadoop_path(spark, path), True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole file there unless one is there already; whether this call did. Of callers at the
    same time one succeeds.

    The file is written aside and moved in one step that never overwrites: a link where the store is
    a local folder, a rename elsewhere, which has to be atomic there, as in HDFS.
    """
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    fs, jvm = _fs(spark, path), spark._jvm
    out = fs.create(_hadoop_path(spark, aside), False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    try:
        if fs.getScheme() == "file":
            files = jvm.java.nio.file.Files
            files.createLink(*(jvm.java.io.File(fs.makeQualified(_hadoop_path(spark, p)).toUri()
                                                .getPath()).toPath() for p in (path, aside)))
        else:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), fs.getConf()).rename(
                _hadoop_path(spark, aside), _hadoop_path(spark, path), spark.sparkContext._gateway
                .new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(_hadoop_path(spark, aside), False)
    return True


def list_dir(spark: SparkSession, path: str) -> dict[str, int]:
    """Names right below a folder, with the time they were last changed; none if it is not there."""
    if not path_exists(spark, path):
        return {}
    return {f.getPath().getName(): f.getModificationTime()
            for f in _fs(spark, path).listStatus(_hadoop_path(spark, path))}


def read_file(spark: SparkSession, path: str) -> str:
    opened = _fs(spark, path).open(_hadoop_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsparkSession.sessionState()
                                                   .newHadoopConf())


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, else one in the warehouse. On a
    cluster a warehouse in a driver's local folder is no such place."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return f"{warehouse}/_shared".rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and continue from there, keeping its partitions and order."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)
