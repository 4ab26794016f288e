"""Picks that spread a title over tasks, and usage without the plays of unlicensed titles."""

import random

from pyspark.sql import functions as F

from screenroi.operators.licensing import pick_license, pick_license_spread
from screenroi.operators.metrics import licensed_plays, usage_by_title_region_year

from conftest import rows

USAGE = "title_id string, region string, year int, total_watch_hours double, unique_viewers long"
LICENCES = "title_id string, license_region string, license_cost_usd_millions double, license_year int"


def test_spread_pick_equals_the_pick(spark):
    """Random sets: undated licences, null costs and regions, ties, null usage years, unlicensed titles, no title."""
    rng = random.Random(5)
    years, regions = [None, 2018, 2019, 2020, 2021], ["US", "GB", "DE", "UNKNOWN"]
    usage = list({(f"t{rng.randrange(60)}", rng.choice(regions), rng.choice(years)) for _ in range(900)}) + [(None, "US", 2020)]
    licences = [(f"t{rng.randrange(50)}", rng.choice(regions + [None]), rng.choice([None, 1.0, 2.0, 3.0]),
                 rng.choice([None, 2017, 2019, 2020, 2023])) for _ in range(160)] + [(None, "US", 1.0, 2020)]
    u = spark.createDataFrame([(*k, 1.0, 1) for k in usage], USAGE).repartition(4)
    lic = spark.createDataFrame(licences, LICENCES).repartition(3)
    for how in ("inner", "left"):
        want = rows(pick_license(u.filter("title_id IS NOT NULL"), lic.filter("title_id IS NOT NULL"), how))
        assert rows(pick_license_spread(u.filter("title_id IS NOT NULL"), lic.filter("title_id IS NOT NULL"), how)) == want
        assert want


def test_one_title_of_a_hundred_thousand_groups_is_many_tasks(spark):
    usage = spark.range(100_000).selectExpr(
        "'t' AS title_id", "concat('r', id div 200) AS region", "cast(1900 + id % 200 as int) AS year", "1.0D AS total_watch_hours",
        "1L AS unique_viewers")
    lic = spark.range(30_000).selectExpr("'t' AS title_id", "concat('r', id div 60) AS license_region",
                                         "cast(id as double) AS license_cost_usd_millions", "cast(1950 + id % 60 as int) AS license_year")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = pick_license_spread(usage, lic).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        tasks = [r["count"] for r in found]
        assert sum(tasks) == 100_000 and len(tasks) == 8 and max(tasks) < 25_000
        whole = pick_license(usage, lic).withColumn("task", F.spark_partition_id()).groupBy("task").count().count()
        assert whole == 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    sums = [df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[0] for df in (pick_license(usage, lic), pick_license_spread(usage, lic))]
    assert sums[0] == sums[1]


def test_plays_of_unlicensed_titles_leave_first(spark):
    plays = spark.range(4000).selectExpr("concat('t', id % 200) AS title_id", "10.0D AS watch_duration_mins", "'US' AS region",
                                         "cast(id % 7 as string) AS user_id", "date'2020-01-01' AS watch_date", "2020 AS year")
    lic = spark.range(50).selectExpr("concat('t', id) AS title_id", "'US' AS license_region", "1.0D AS license_cost_usd_millions",
                                     "2020 AS license_year")
    kept = licensed_plays(plays, lic)
    assert 1000 <= kept.count() < 1100 and kept.columns == plays.columns
    assert licensed_plays(plays, lic.limit(0)).count() == 0
    want = pick_license(usage_by_title_region_year(plays), lic)
    assert rows(pick_license(usage_by_title_region_year(kept), lic)) == rows(want)
    plan = usage_by_title_region_year(kept)._jdf.queryExecution().executedPlan().toString()
    # printed above = runs after: plays are looked up before the first exchange of usage
    assert plan.index("Exchange hashpartitioning(title_id") < plan.index("LeftSemi")
