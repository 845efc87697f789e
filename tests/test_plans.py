"""Plan-shape guards: the properties the scale design relies on."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(spark, name: str) -> str:
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_version_limits_before_the_shuffle(spark):
    lines = plan_of(spark, "cdc_latest").splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(id" in line)
    assert exchange < partial  # printed top-down: the partial limit runs below (before) it


def test_date_range_prunes_folders(spark):
    scan = next(line for line in plan_of(spark, "partition_range").splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date" in scan and "date#" in scan.split("PartitionFilters")[1]


@pytest.mark.parametrize("mode", ["any", "latest"])
def test_current_rows_parse_once(spark, tmp_dir, mode):
    """On written messages: one scan, one parse, one shuffle by id, no join."""
    from tallyspark.operators import changes as chg
    from tallyspark.plans import inputs as I

    I.change_messages(spark, SF).select("value").write.text(f"{tmp_dir}/messages")
    rows = chg.current_rows(chg.parse_changes(spark.read.text(f"{tmp_dir}/messages")), deletes_mode=mode)
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate") == 1 and "Join" not in plan
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_null_keys_skip_the_asof_windows(spark):
    plan = plan_of(spark, "asof_features")
    assert "Union" in plan and "isnotnull(user_id" in plan


def test_pure_filter_has_no_shuffle(spark):
    assert "Exchange" not in plan_of(spark, "filter_date")


def test_backfill_counts_values_by_intervals(spark):
    plan = plan_of(spark, "backfill_features")
    assert "Expand" not in plan and "Generate explode(sequence" not in plan
    # days of a (key, value) and of a key are collected before their shuffles
    assert plan.count("partial_collect_set(__d") == 3


@pytest.mark.parametrize("name", ["asof_features", "asof_features_ttl", "multi_view_features",
                                  "online_lookup", "compare_features", "cdc_anti_join"])
def test_no_pairwise_joins(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_asof_shuffles_by_key_and_bucket(spark):
    plan = plan_of(spark, "asof_features")
    assert "Exchange hashpartitioning(__k0#" in plan and ", __b#" in plan
    assert "Join" not in plan  # nothing is joined back


def test_online_read_semi_joins_the_keys(spark):
    assert "LeftSemi" in plan_of(spark, "online_lookup")
