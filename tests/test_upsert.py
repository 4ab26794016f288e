"""Curated sets by landings, and quality reports from the states of loads."""

import os
import random

from pyspark.sql import functions as F

from screenroi.operators.dedupe import keep_first
from screenroi.operators.incremental import FactStore
from screenroi.operators.quality import check_all
from screenroi.operators.upsert import BUCKET, CuratedStore

from conftest import rows
from test_incremental import staging


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_landings_equal_all_at_once(spark, scratch):
    rng = random.Random(2)
    data = [(f"k{rng.randrange(80)}" if i % 50 else None, rng.choice([None, "a", "b"]), rng.randrange(4), float(i % 3)) for i in range(400)]
    schema = "id string, name string, n int, x double"
    whole = spark.createDataFrame(data, schema)
    store = CuratedStore(spark, f"{scratch}/set", ["id"], buckets=8)
    for part in (data[:150], data[100:300], data[250:], data[:10]):
        store.upsert(spark.createDataFrame(part, schema).repartition(3))
    assert rows(store.table(whole).drop(BUCKET)) == rows(keep_first(whole, ["id"]))
    assert store.upsert(keep_first(whole, ["id"])) == []  # what is stored just so writes nothing


def test_untouched_files_stay(spark, scratch):
    store = CuratedStore(spark, f"{scratch}/set", ["id"], buckets=16)
    store.upsert(spark.range(200).selectExpr("concat('k', id) AS id", "id AS n"))
    before = files(f"{scratch}/set")
    written = store.upsert(spark.createDataFrame([("k7", -1), ("new", 5)], "id string, n long"))
    assert 1 <= len(written) <= 2
    gone = before - files(f"{scratch}/set")
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in gone} <= {str(b) for b in written}
    table = store.table(spark.createDataFrame([], "id string, n long"))
    assert table.count() == 201 and table.filter("id = 'k7'").first().n == -1
    # a larger row does not replace a smaller one
    store.upsert(spark.createDataFrame([("k7", 99)], "id string, n long"))
    assert table.sparkSession.read.parquet(f"{scratch}/set").filter("id = 'k7'").first().n == -1


def test_report_from_states_equals_the_full_pass(spark, scratch):
    store = FactStore(spark, f"{scratch}/store")
    for k, years in enumerate(([2000], [2000, 2001], [2002, 2002])):
        batch = staging(spark, years, 5 + 3 * k).withColumns({
            "cost_per_hour_watched": F.when(F.col("year") == 2001, F.lit(-1.0)),
            "sentiment_score": F.when(F.col("title_id") == "t1", F.lit(1.5))})
        store.load(batch)
    title = spark.createDataFrame([("t0",), ("t1",), ("t1",)], "title_id string")
    region = spark.createDataFrame([("US", "x"), ("UNKNOWN", None)], "region_code string, region_name string")
    date = spark.createDataFrame([(20000101, 2000), (20010101, None)], "date_id int, year int").selectExpr(
        "date_id", "current_date() AS full_date", "year", "1 AS quarter", "1 AS month", "'January' AS month_name", "1 AS week", "1 AS day",
        "1 AS day_of_week")
    want = rows(check_all(store.table(), title, region, date, min_rows=10))
    report = store.check(title, region, date, min_rows=10)
    assert rows(report) == want and any(not r.passed for r in report.collect())
    assert "/fact" not in " ".join(report.inputFiles())
    # the state of a load that broke off does not count
    store.states().write.parquet(f"{scratch}/store/state/load=9")
    assert rows(store.check(title, region, date, min_rows=10)) == want
