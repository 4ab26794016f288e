"""Steps that once moved or held more than they need."""

import re

import pytest
from pyspark.sql import functions as F

from screenroi.operators.licensing import pick_license
from screenroi.operators.metrics import content_performance
from screenroi.operators.upsert import PARTS, CuratedStore
from screenroi.operators.warehouse import Warehouse, load_staging
from screenroi.sources import bindings as b

from conftest import rows
from test_incremental import physical, staging

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled_joins(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def below(plan, found):
    """The lines under the first line that holds ``found``."""
    lines = plan.split("\n")
    at = next(i for i, l in enumerate(lines) if found in l)
    depth = len(re.match(r"[\s:+|-]*", lines[at]).group())
    own = []
    for l in lines[at + 1:]:
        if len(re.match(r"[\s:+|-]*", l).group()) <= depth:
            break
        own.append(l)
    return "\n".join(own)


def test_the_pick_sorts_three_times_in_all_its_partitions(spark):
    usage = spark.createDataFrame([("t", "US", 2020, 1.0, 1)],
                                  "title_id string, region string, year int, total_watch_hours double, unique_viewers long")
    lic = spark.createDataFrame([("t", "US", 1.0, 2019)],
                                "title_id string, license_region string, license_cost_usd_millions double, license_year int")
    plan = physical(pick_license(usage, lic))
    assert len(re.findall(r"\bSort \[", plan)) == 3
    assert "REPARTITION_BY_NUM" in plan


def test_order_lines_move_once_to_their_orders(spark, shuffled_joins):
    plan = physical(b.watch_history_raw(b.Tables(spark, SF)))
    assert "l_orderkey" not in below(plan, "Exchange hashpartitioning(o_custkey")
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_churn_meets_narrow_groups(spark, shuffled_joins):
    watch = spark.createDataFrame(
        [(f"s{i}", f"u{i % 5}", f"t{i % 4}", None if i % 6 == 0 else f"{2000 + i % 3}-02-01", 30.0, "US" if i % 2 else "GB") for i in range(60)],
        "session_id string, user_id string, title_id string, watch_date string, watch_duration_mins double, region string")
    lic = spark.createDataFrame([(f"t{i}", "US", 1.0 + i, 2001) for i in range(4)],
                                "title_id string, region string, license_cost_usd_millions double, license_year int")
    movies = spark.createDataFrame([(f"t{i}", f"name {i}") for i in range(3)], "title_id string, title string")
    sent = spark.createDataFrame([("t1", 0.5)], "title_id string, sentiment_score double")
    keys = watch.selectExpr("title_id", "IF(region = 'US', 'US', 'GB') AS region", "year(CAST(watch_date AS date)) AS year").distinct()
    churn = keys.filter("title_id <> 't2'").withColumn("churn_rate_post_title", F.coalesce(F.col("year"), F.lit(7)) / 10000.0)
    churn = churn.unionByName(churn.filter("title_id = 't3'"))  # a key may come twice
    want = load_staging(content_performance(watch, lic, movies, sent), churn=churn)
    got = load_staging(content_performance(watch, lic, movies, sent, churn=churn))
    assert rows(got) == rows(want) and got.columns == want.columns
    assert got.filter("year IS NULL AND churn_rate_post_title = 0.0007").count() > 0
    # neither the catalogue nor ids move, as they did when churn came last
    for line in physical(got).split("\n"):
        if "Exchange hashpartitioning(title_id" in line and "region" in line:
            assert "title_name" not in below(physical(got), line.strip())
    assert "title_name" in below(physical(want), "Exchange hashpartitioning(title_id")


def test_new_facts_are_not_dealt_again(spark, scratch, monkeypatch):
    plans = {}
    append = Warehouse._append

    def kept(self, df, name, sort_by=None):
        plans[name] = physical(df)
        return append(self, df, name, sort_by)

    monkeypatch.setattr(Warehouse, "_append", kept)
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.create()
    assert wh.load(staging(spark, [2000, 2001]))["fact_content_performance"] == 12
    assert "REPARTITION_BY_COL" not in plans["fact_content_performance"]
    assert wh.load(staging(spark, [2001, 2002]))["fact_content_performance"] == 6


def test_a_landing_moves_once(spark, scratch):
    store = CuratedStore(spark, f"{scratch}/set", ["id"], buckets=4)
    first = spark.range(1000).selectExpr("concat('k', id) AS id", "id AS n", "CAST(NULL AS string) AS name")
    assert store.upsert(first) == [0, 1, 2, 3]
    merged = physical(store._merge(store.table(first)))
    assert merged.count("Exchange ") == 1 and "hashpartitioning(key_bucket" in merged
    # null columns are alike; of 1000 rows that are there and one that is not, one bucket is written
    more = first.unionByName(spark.createDataFrame([("new", 1, None)], "id string, n long, name string"))
    assert len(store.upsert(more)) == 1 and store.table(first).count() == 1001
    import os

    for bucket in range(4):
        found = [n for n in os.listdir(f"{scratch}/set/key_bucket={bucket}") if n.endswith(".parquet")]
        assert 1 <= len(found) <= PARTS
