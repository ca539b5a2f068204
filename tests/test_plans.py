"""Plan properties that matter at scale, checked on the registered queries."""

import pytest

from __spark_entry__ import queries
from tests.conftest import SF_CHECK


def plan(spark, name):
    df = queries()[name](spark, SF_CHECK)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["nth_match", "nested_detect", "sentiment", "label_top1", "raster_zoom",
                                  "parse_pairs", "extract_to", "detect_format", "put_content", "delay_gate"])
def test_per_row_operators_do_not_shuffle(spark, name):
    # the only exchange allowed is the round-robin spread of an input with
    # fewer partitions than cores (never taken by large tables)
    p = plan(spark, name)
    for kind in ("hashpartitioning", "rangepartitioning", "SinglePartition", "BroadcastExchange"):
        assert kind not in p


@pytest.mark.parametrize("name", ["changed_ids", "deleted_ids", "run_query", "quota_usage", "metric_json",
                                  "assemble_transcript"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    p = plan(spark, name)
    assert "Exchange hashpartitioning" in p
    assert "partial_" in p


@pytest.mark.parametrize("name", ["capped_actions_per_key", "top_k_annotations"])
def test_per_key_top_k_limits_before_the_shuffle(spark, name):
    p = plan(spark, name)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_reach_the_scan(spark):
    p = plan(spark, "incremental_extract")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in p
    p = plan(spark, "changed_ids")
    assert "GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_columns_are_pruned(spark):
    # routing by labels never reads the document text
    assert "ReadSchema: struct<doc_id:bigint>" in plan(spark, "route_split")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan(spark, "capped_actions")


def test_small_checked_sides_are_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "row_lookup")
    assert "BroadcastHashJoin" in plan(spark, "lookup_enrich")


def test_global_cap_uses_top_k_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "capped_actions")


def test_folder_scan_never_reads_file_content(spark):
    # levels of listed entries, no source that reads files
    p = plan(spark, "scan_inventory")
    assert "binaryFile" not in p and "FileScan parquet [path" in p


def test_spread_leaves_shuffled_inputs_alone(spark):
    from flowtable.session import spread

    small = spark.range(100).coalesce(1)
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    shuffled = spark.range(100).selectExpr("id % 3 AS k").groupBy("k").count()
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = spread(shuffled)
    assert out is shuffled
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs_before
