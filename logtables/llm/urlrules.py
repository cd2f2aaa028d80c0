"""URL rules by a sort-merge range join: reversed hosts and paths are keys, rules are nested intervals.

A rule's key is its reversed host and its path; what the rule fits on that host has the key as a
prefix. Such intervals nest, so in key order the active rules are a stack. A page is looked up under its
host and under each host above it. Pages and the ends of intervals are sorted together, dealt by ranges,
and swept once; the top of the stack at the end of a range is carried into the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtables.llm.shared import kept

RULES = "action string, host string, path string"
#: Pages to a range of keys.
PAGES_PER_SWEEP = 250_000


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULES)


def url_parts(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty if the url is null or has no `://`."""
    url = F.col(url) if isinstance(url, str) else url
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    low = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: str | Column) -> Column:
    """`a.example.org` to `org.example.a.`: subdomains of a host share its key as a prefix."""
    host = F.col(host) if isinstance(host, str) else host
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def canonical(host_key_: str | Column, path: str | Column) -> Column:
    """A host's key and a path as one key of bytes; no other host's key is a prefix of it."""
    return F.concat(host_key_, F.lit("\0"), path).cast("binary")


def above(host: str | Column) -> Column:
    """The keys of a host and of all hosts above it."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(
        F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))


def rule_of(size: Column, host_size: Column, rule: Column, action: Column) -> Column:
    """A rule as it is compared: the longest one wins, then the longer host, then the larger text."""
    return F.struct(size.cast("int").alias("size"), host_size.cast("int").alias("host_size"),
                    rule.cast("string").alias("rule"), action.cast("string").alias("action"))


def boundaries(rules: DataFrame) -> DataFrame:
    """Where the top of the stack changes: (key, top), from the rules alone.

    A rule's interval starts at its key and ends behind all keys it is a prefix of, at the key and a
    byte that is in no text. From its start on it is on top, from its end on the rule around it:
    that of the longest shorter path on the same host, or none, which has the size -1.
    """
    known = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(
        # `block` before `allow` if both are given.
        F.max("action").alias("action")).select(
        host_key("host").alias("host_key"), "path", rule_of(
            F.length(F.concat("host", "path")), F.length("host"), F.concat("host", "path"),
            F.col("action")).alias("own"))
    none = rule_of(F.lit(-1), F.lit(-1), F.lit(None), F.lit(None))
    shorter = known.select("host_key", "path", "own", F.explode(F.sequence(
        F.lit(0), F.length("path"))).alias("n")).where("n < length(path)").select(
        "host_key", F.col("path").alias("inner"), F.substring("path", F.lit(1), F.col("n"))
        .alias("path"))
    around = shorter.join(known, ["host_key", "path"]).groupBy("host_key", F.col("inner").alias(
        "path")).agg(F.max("own").alias("outer"))
    ends = known.join(around, ["host_key", "path"], "left").select(
        F.concat(canonical("host_key", "path"), F.lit(b"\xff")).alias("key"),
        F.coalesce("outer", none).alias("top"))
    return known.select(canonical("host_key", "path").alias("key"), F.col("own").alias("top")
                        ).unionByName(ends)


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
               otherwise: str = "allow", pages_per_sweep: int = PAGES_PER_SWEEP) -> DataFrame:
    """The rule and verdict of each page's url: (page id, host, path, rule, verdict).

    A rule fits its host and all subdomains where the url's path starts with the rule's path. The
    longest rule (host and path together) wins; of equally long ones that with the longer host,
    then the larger text; `block` before `allow` when one rule is given twice. No rule: null and
    `otherwise`. Rules with a null host or path are left out.

    Each page stands once for its host and once for each host above, some three rows. They are dealt by
    ranges of key and page, so neither a host nor a url with a third of all pages has to fit one task,
    and rules are read once, whatever their number on a host. One row out per row in, repeated and null
    ones too; empty tables are fine; other columns are not read.
    """
    host, path = url_parts(url)
    marks = boundaries(rules)
    seen = pages.select(F.monotonically_increasing_id().alias("row"), F.col(page_id).alias("page"),
                        host.alias("host"), path.alias("path"))
    kind = dict(marks.dtypes)["top"]
    asked = seen.select(F.explode(above("host")).alias("host_key"), "row", "page", "host", "path")
    events = asked.select(canonical("host_key", "path").alias("key"), "row", "page", "host", "path",
                          F.lit(None).cast(kind).alias("top")).unionByName(
        marks.select("key", F.lit(-1).cast("bigint").alias("row"),
                     F.lit(None).cast(pages.schema[page_id].dataType).alias("page"),
                     F.lit("").alias("host"), F.lit("").alias("path"), "top"))
    sweeps = max(pages.sparkSession.sparkContext.defaultParallelism,
                 -(-pages.count() // pages_per_sweep))
    # Written once: which range a row is in, and its number, stay as they are. A boundary comes
    # before pages of the same key.
    placed = kept(events.repartitionByRange(sweeps, "key", "row").withColumn(
        "sweep", F.spark_partition_id()))
    order = Window.partitionBy("sweep").orderBy("key", "row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    swept = placed.withColumn("here", F.last("top", ignorenulls=True).over(order))
    # A row for each range.
    ends = placed.groupBy("sweep").agg(F.max_by("top", F.when(
        F.col("top").isNotNull(), F.struct("key", "row"))).alias("last"))
    carried = ends.select("sweep", F.last("last", ignorenulls=True).over(Window.orderBy(
        "sweep").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    best = F.max(F.coalesce("here", "before")).alias("best")
    judged = swept.where("row >= 0").join(F.broadcast(carried), "sweep").groupBy(
        "row", "page", "host", "path").agg(best)
    return judged.select(
        F.col("page").alias(page_id), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(otherwise)).alias("verdict"))
