"""What the physical plans must and must not hold."""

import os
import re

import pytest

from tidegate.workload import QUERIES

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="driver tables are absent")

# Queries whose result is a scan of what they wrote: their plans are those of their steps.
WRITING = {
    "ingest_json_good", "ingest_json_quarantined", "ingest_delimited", "run_dataset", "history_load", "stream_ingest",
    "stream_dedup", "export_flat_csv", "partition_overwrite", "partitioned_write_read", "quarantine_roundtrip",
    "csv_roundtrip", "delimited_scan", "multiline_scan", "json_props", "incremental_rows", "flatten_separate_arrays",
    "tenant_of_file", "rule_violations",
}
SHUFFLES = {
    "flatten_structs": 0, "flatten_leaf_names": 0, "flatten_order_docs": 0, "flatten_sibling_arrays": 0,
    "pad_project_rename": 0, "declared_cast": 0, "tenant_from_link": 0, "import_date_parts": 0, "null_check_flag": 0,
    "quarantine_split": 0, "rule_check_rows": 0, "route_files": 0, "scalar_misc": 0, "runs_silver_units": 0,
    "dedup_rows": 1, "dedup_ignoring_lineage": 1, "daily_sum": 1, "last_value_pivot": 1, "runs_gold": 1,
    "distinct_users": 1, "audit_latest": 1, "ingest_plan": 1, "load_metrics": 1, "cast_failures": 1, "load_slice": 1,
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan_stays_native(spark, name):
    plan = physical(QUERIES[name](spark, TABLES))
    for forbidden in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "Window", "MapInPandas"):
        assert forbidden not in plan, plan


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_number_of_shuffles(spark, name):
    """Broadcasts and the dealing out of an unsplittable test file are not counted."""
    plan = physical(QUERIES[name](spark, TABLES))
    found = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)
    assert len(found) == SHUFFLES[name], plan


def test_grouped_work_is_done_map_side_first(spark):
    for name, partial in {"daily_sum": "partial_sum", "last_value_pivot": "partial_max_by", "audit_latest": "partial_max"}.items():
        assert partial in physical(QUERIES[name](spark, TABLES))


def test_load_date_reaches_the_scan_and_only_needed_columns_are_read(spark):
    plan = QUERIES["load_slice"](spark, TABLES)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert re.search(r"PushedFilters: \[IsNotNull\(l_shipdate\), GreaterThanOrEqual\(l_shipdate", text)
    assert "l_quantity" not in text and "l_partkey" not in text


def test_large_stage_shares_one_shuffle_over_both_joins(spark):
    from tidegate.operators import history as ops

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stage = spark.range(10).selectExpr("id AS k", "CAST(id AS DOUBLE) AS v")
        current = spark.range(100).selectExpr("id AS k", "CAST(id AS DOUBLE) AS v")
        plan = physical(ops.compare_rows(stage, current, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The stage, its keys and the current rows: the reduced current rows are not shuffled again.
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 3


def test_small_stage_filters_the_history_before_its_shuffle(spark, folder):
    """The written stage is known to be small and is broadcast; only its keys' current rows go on."""
    from tidegate.operators import history as ops

    path, stage_path = folder(), folder()
    spark.range(50_000).selectExpr("id AS k", "CAST(id AS DOUBLE) AS v").write.parquet(path)
    spark.range(1).selectExpr("id AS k", "CAST(9 AS DOUBLE) AS v").write.parquet(stage_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        pairs = ops.compare_rows(spark.read.parquet(stage_path), spark.read.parquet(path), ["k"])
        plan = physical(pairs)
        assert pairs.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    semi = plan[plan.index("LeftSemi"):]
    assert re.search(r"BroadcastHashJoin [^\n]*LeftSemi", plan)
    assert "Exchange hashpartitioning" not in semi
