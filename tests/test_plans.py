"""Shapes of physical plans that must hold at scale."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from logtables.operators import dedup, fields, filters, rows
from logtables.operators.batching import byte_batches
from logtables.plans import inputs, log_export
from logtables.plans.catalogue import CHECKED, QUERIES
from logtables.sinks.tables import route, write_attempt
from logtables.spec import FieldSet

SF = "/root/testdata/sf0.001"
# These write while they are built; what they return is a read.
WRITING = ("export_table export_ledger export_gaps export_other_time export_rerun run_list "
           "run_lookup route_tables create_tables snapshot_backup snapshot_read "
           "snapshot_replace snapshot_history stream_dedup stream_export stream_rejects "
           "export_concurrent export_takeover export_null_ids export_vacuum ledger_compacted "
           "stored_min_level stream_windows stream_closed_rows stream_late stream_batches").split()
NARROW = ("scan_log_range app_log_lines fields_http fields_instance fields_timestamp fields_user "
          "fields_version format_values custom_fields min_level skip_predicate required_ok "
          "align_time assign_window on_time_rows late_rows csv_lines schema_hash schema_fields "
          "kind_uris").split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(WRITING)))
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", NARROW)
def test_row_by_row_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF))


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["fields_timestamp"](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_page_text_is_measured_below_the_join(spark):
    """The join carries the length of a page, not the page."""
    plan = plan_of(rows.export_rows(inputs.request_logs(spark, SF), fields.BASIC))
    above = plan[:plan.index("length(html")]
    assert not re.search(r"\bhtml#", above)


def test_duplicates_are_merged_before_the_shuffle(spark):
    logs = inputs.core_logs(spark, SF).select("request_id", "arrival_usec", "nickname")
    for found in (dedup.dedup(logs, "request_id"), dedup.dedup(logs, "request_id", ["arrival_usec"])):
        plan = plan_of(found)
        assert plan.count("Exchange") == 1
        assert "partial_" in plan[plan.index("Exchange"):]


def test_splitting_rejects_stays_linear_in_the_fields(spark):
    """A filter over every renamed field would make the optimizer's work exponential."""
    checked = log_export.checked_window_rows(inputs.request_logs(spark, SF), CHECKED)
    for found in (rows.valid_rows(checked, CHECKED.field_set, ["window_start"]),
                  rows.reject_rows(checked, CHECKED.field_set)):
        constraints = found._jdf.queryExecution().optimizedPlan().constraints()
        assert constraints.size() < 200


def test_batches_broadcast_one_row_per_slice(spark):
    sized = inputs.row_sizes(spark, SF)
    plan = plan_of(byte_batches(sized, ["lang"], ["doc_id"], "row_bytes", slices=4))
    assert plan.count("BroadcastHashJoin") == 1
    # Chains are walked above an exchange by group, the summaries are made below it.
    walk, summaries = plan.index("MapInPandas"), plan.rindex("MapInArrow")
    assert walk < plan.index("Exchange hashpartitioning(group") < summaries


def test_the_level_filter_reads_levels_only(spark, tmp_path):
    inputs.core_logs(spark, SF).write.parquet(f"{tmp_path}/logs")
    found = filters.min_level(spark.read.parquet(f"{tmp_path}/logs"), 3).select("request_id")
    plan = found._jdf.queryExecution().toString()
    assert "app_logs:array<struct<level:int>>" in plan and "message" not in plan.split("Physical")[1]


def test_stored_levels_let_row_groups_be_skipped(spark, tmp_path):
    from logtables.sinks import logs as log_store
    from logtables.sources import logs as log_source
    logs = inputs.core_logs(spark, SF).drop("event_time").withColumn(
        "nickname", F.repeat(F.col("nickname"), 200))
    log_store.store(logs.withColumn("start_time_usec", F.col("start_time_usec") % 86_400_000_000),
                    f"{tmp_path}/logs", row_group=4096)
    stored = spark.read.parquet(f"{tmp_path}/logs")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(filters.min_level(log_source.scan_range(stored, 0, 80_000_000), 4))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(top_level,4)" in plan and "LessThan(start_time_usec," in plan
    expected = filters.min_level(logs, 4)
    assert filters.min_level(stored, 4).count() == expected.count() > 0
    # Groups that may hold such a row, by their statistics, are a part of all.
    import pyarrow.parquet as pq
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in (tmp_path / "logs").rglob("*.parquet")
              for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    tops = [g.column(j).statistics.max for g in groups for j in range(g.num_columns)
            if g.column(j).path_in_schema == "top_level" and g.column(j).statistics.has_min_max]
    assert len(groups) > 2 and sum(t >= 4 for t in tops) < len(groups)


def test_an_export_scans_once_and_shuffles_once(spark, tmp_path, monkeypatch):
    """Rows, rejects, the removal of copies and the files: one pass and one exchange of the rows."""
    inputs.core_logs(spark, SF).drop("event_time").write.parquet(f"{tmp_path}/logs")
    logs = spark.read.parquet(f"{tmp_path}/logs")
    config = CHECKED.__class__("w", FieldSet((fields.HTTP, fields.TIMESTAMP)),
                               max_row_bytes=1000, window_ms=86_400_000)
    plans = []
    real = DataFrame.write.fget

    def seen(df):
        plans.append(plan_of(df))
        return real(df)

    monkeypatch.setattr(DataFrame, "write", property(seen))
    write_attempt(log_export.outcomes(logs, config), config, str(tmp_path / "out"), "a",
                  "requestId", 4)
    assert len(plans) == 1
    assert plans[0].count("Exchange") == 1 and plans[0].count("FileScan") == 1


def test_window_writes_are_rebalanced(spark):
    found = log_export.window_rows(inputs.core_logs(spark, SF).selectExpr(
        "*", "'' AS host", "'' AS resource", "0L AS response_size"), CHECKED.__class__(
            "w", fields.BASIC))
    hinted = route(found, CHECKED).hint("rebalance", "table_id", "window_start")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(hinted)
