import pytest

from screenroi.plans.pipeline import JobPaths, run_content_performance, run_pipeline
from screenroi.operators.metrics import LicenceGateError
from screenroi.sources import bindings as b
from screenroi.sources.files import land_raw

SF = "/root/testdata/sf0.001"


def test_job_paths():
    p = JobPaths(raw_root="/raw", curated_root="/cur", explicit={"curated:movies": "/x/m"})
    assert p.raw("users") == "/raw/users/"
    assert p.curated("movies") == "/x/m"
    assert p.curated("reviews") == "/cur/sentiment/"
    with pytest.raises(ValueError):
        JobPaths().raw("users")


def test_full_pipeline_from_raw_csv(spark, scratch):
    t = b.Tables(spark, SF)
    raw = f"{scratch}/raw"
    for folder, df in {
        "watch_history": b.watch_history_raw(t), "movies": b.movies_raw(t), "reviews": b.reviews_raw(t),
        "licensing": b.licensing_raw(t), "search_logs": b.search_logs_raw(t), "users": b.users_raw(t),
        "recommendation_logs": b.recommendation_logs_raw(t),
    }.items():
        land_raw(df, raw, folder, 2024, 3)
    report = run_pipeline(spark, raw, f"{scratch}/curated", f"{scratch}/warehouse", f"{scratch}/mart")
    got = {r.rule: r.passed for r in report.collect()}
    assert all(got.values()), got
    mart_rows = spark.read.parquet(f"{scratch}/mart").count()
    assert mart_rows == spark.read.parquet(f"{scratch}/curated/content_performance").filter(
        "year is not null").count() > 1000  # the fact takes rows with a year
    search = spark.read.parquet(f"{scratch}/curated/search_logs")
    assert "region" in search.columns and search.count() > 0
    # Re-running the load adds nothing.
    again = run_pipeline(spark, raw, f"{scratch}/curated", f"{scratch}/warehouse", f"{scratch}/mart")
    assert spark.read.parquet(f"{scratch}/warehouse/fact_content_performance").count() == mart_rows
    assert all(r.passed for r in again.collect())


def test_gate_stops_before_writing(spark, scratch):
    cur = f"{scratch}/curated"
    spark.createDataFrame([("s1", "u1", "t1", "2024-03-01", 10.0, "US")],
                          "session_id string, user_id string, title_id string, watch_date string, "
                          "watch_duration_mins double, region string").write.parquet(f"{cur}/watch_history")
    spark.createDataFrame([("t2", None, 1.0, 2024, "US")], "title_id string, title_name string, "
                          "license_cost_usd_millions double, license_year int, region string").write.parquet(f"{cur}/licensing")
    spark.createDataFrame([("t1", "x")], "title_id string, title string").write.parquet(f"{cur}/movies")
    spark.createDataFrame([("t1", 0.5)], "title_id string, sentiment_score double").write.parquet(f"{cur}/sentiment")
    with pytest.raises(LicenceGateError):
        run_content_performance(spark, JobPaths(curated_root=cur), f"{cur}/content_performance")
    import os
    assert not os.path.exists(f"{cur}/content_performance")
