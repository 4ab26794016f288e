"""Plan guards: the physical shapes the scale design depends on."""

import re

import pytest
from pyspark.sql import functions as F

from screenroi.operators.dedupe import keep_first
from screenroi.operators.licensing import pick_license
from screenroi.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udfs_or_pair_joins(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "RoundRobinPartitioning"):
        assert bad not in plan, f"{name}: {bad}"


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("v"))
    lines = physical(keep_first(df, ["k"])).split("\n")
    partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and l.rstrip().endswith("Partial")]
    exchange = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(k" in l]
    assert partial and exchange and exchange[0] < partial[0]  # printed above = runs after


def test_licence_pick_is_one_title_shuffle_without_join(spark):
    usage = spark.createDataFrame([("t", "US", 2020, 1.0, 1)],
                                  "title_id string, region string, year int, total_watch_hours double, unique_viewers long")
    lic = spark.createDataFrame([("t", "US", 1.0, 2019)],
                                "title_id string, license_region string, license_cost_usd_millions double, license_year int")
    plan = physical(pick_license(usage, lic))
    assert "Join" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(title_id#\d+, \d+\)", plan)) == 1
    assert plan.count("Window [") >= 3
    assert "unboundedfollowing" not in plan  # such a frame is read again for every row


def test_usage_aggregates_partially_before_shuffles(spark):
    plan = physical(QUERIES["usage_by_title_region_year"](spark, SF))
    assert "partial_sum" in plan and "partial_count(user_id" in plan and "partial_collect_list" in plan
