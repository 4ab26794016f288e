"""Digests, loads that read only the dates of their batch, bucketed tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

from screenroi.operators.digest import key_digest, split_by_digest
from screenroi.operators.incremental import FactStore, order_breaks, write_bucketed
from screenroi.operators.models import content_performance_mart
from screenroi.operators.warehouse import DIM_TITLE_SCHEMA, FACT_SCHEMA, STAGING_SCHEMA, Warehouse

from conftest import rows


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("words", [1, 16, 1 << 12])
def test_digest_loses_no_key(spark, words):
    keys = spark.range(500).selectExpr("concat('k', id) AS key", "id % 3 AS g")
    probe = spark.range(1000).selectExpr("IF(id = 999, NULL, concat('k', id)) AS key", "id % 3 AS g")
    for by in ((), ("g",)):
        maybe, new = split_by_digest(probe, "key", key_digest(keys, "key", by, words), by, words)
        found = {r.key for r in maybe.collect()}
        assert {f"k{i}" for i in range(500)} <= found
        assert len(found) + new.count() == 1000 and new.filter("key IS NULL").count() == 1
        if words == 1 << 12:
            assert len(found) < 520
        if words == 1:  # a digest that is full lets all through
            assert by or len(found) == 999


def staging(spark, years, n=6, start=0):
    made = [(f"p{y}-{i}", f"t{i % 4}", "US" if i % 3 else None, y, float(i)) for y in years for i in range(start, start + n)]
    named = spark.createDataFrame(made, "performance_id string, title_id string, region string, year int, total_watch_hours double")
    return named.select(*[F.col(f.name) if f.name in named.columns else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in STAGING_SCHEMA.fields])


def test_pruned_loads_equal_plain_ones(spark, scratch):
    first, second = staging(spark, [2000, 2001]), staging(spark, [2001, 2002], 9)
    batches = [first, second, second.unionByName(staging(spark, [2003], 2)).unionByName(staging(spark, [2003], 2)), first]
    for words in (1, 1 << 10):
        store, plain = FactStore(spark, f"{scratch}/s{words}", words), Warehouse(spark, f"{scratch}/w{words}")
        plain.create()
        for k, batch in enumerate(batches):
            assert store.load(batch) == plain.load(batch)["fact_content_performance"], k
            assert rows(store.table()) == rows(plain.table("fact_content_performance"))
    keys = [r.performance_id for r in store.table().collect()]
    assert keys.count("p2003-0") == 2  # repeated inside one batch
    once = FactStore(spark, f"{scratch}/once")
    assert once.load(batches[2], dedupe=True) == once.table().select("performance_id").distinct().count()


def test_a_load_reads_its_own_dates_only(spark, scratch):
    store = FactStore(spark, f"{scratch}/store")
    store.load(staging(spark, [2000, 2001, 2002]))
    for year in (2000, 2002):  # whoever reads these folders fails
        with open(f"{scratch}/store/fact/load=0/date_id={year}0101/part-broken.snappy.parquet", "wb") as out:
            out.write(b"not a table")
    batch = staging(spark, [2001, 2005], 8)
    new = store.new_rows(batch)
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", physical(new))
    assert sorted(r.performance_id for r in new.collect()) == sorted(
        [f"p2001-{i}" for i in (6, 7)] + [f"p2005-{i}" for i in range(8)])
    assert store.load(batch) == 10
    with pytest.raises(Exception):
        store.table().collect()


def test_a_broken_load_is_repeated(spark, scratch):
    """The digest is written first: what it announces and the table lacks is looked up, and loaded."""
    store = FactStore(spark, f"{scratch}/store")
    store.load(staging(spark, [2000], 2))
    batch = staging(spark, [2000], 5)
    key_digest(batch, "performance_id", ["year"], store.words).select(
        (F.col("year") * 10000 + 101).alias("date_id"), "slot", "bits").write.parquet(f"{scratch}/store/digest/load=1")
    assert store.load(batch) == 3 and store.load(batch) == 0
    assert store.table().count() == 5


def test_bucketed_tables_join_without_exchange(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucket_test LOCATION '{scratch}/db'")
    fact = spark.range(300).selectExpr("concat('p', id) AS performance_id", "concat('t', id % 40) AS title_id", "'US' AS region_code",
                                       "20000101 AS date_id")
    fact = fact.select(*[F.col(f.name) if f.name in fact.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA.fields])
    titles = spark.range(40).selectExpr("concat('t', id) AS title_id", "concat('name', id) AS title_name")
    titles = titles.select(*[F.col(f.name) if f.name in titles.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in DIM_TITLE_SCHEMA.fields])
    stored_fact = write_bucketed(fact, "bucket_test.fact", f"{scratch}/fact", 4, sort_by=["title_id", "date_id"])
    stored_titles = write_bucketed(titles, "bucket_test.dim_title", f"{scratch}/dim_title", 4)
    assert order_breaks(stored_fact, ["title_id", "date_id"]).first() == (300, 0)
    assert order_breaks(stored_fact, ["performance_id"]).first().breaks > 0
    assert len([n for n in os.listdir(f"{scratch}/fact") if n.endswith(".parquet")]) == 4
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored_fact.join(stored_titles, "title_id", "left")
        by_title = stored_fact.groupBy("title_id").count()
        for plan in (physical(joined), physical(by_title)):
            assert "Exchange" not in plan
        assert "SortMergeJoin" in physical(joined)
        assert "Exchange hashpartitioning(title_id" in physical(fact.join(titles, "title_id", "left"))
        dates = spark.createDataFrame([(20000101, 2000)], "date_id int, year int")
        mart = content_performance_mart(stored_fact, stored_titles, spark.createDataFrame([("US", "x")], "region_code string, region_name string"),
                                        dates.selectExpr("date_id", "current_date() AS full_date", "year", "1 AS quarter", "1 AS month",
                                                         "'January' AS month_name", "1 AS week", "1 AS day"))
        assert "hashpartitioning(title_id" not in physical(mart)
        assert mart.filter("title_name IS NOT NULL").count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
