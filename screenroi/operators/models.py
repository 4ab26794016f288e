"""Reporting models over the star schema: three staging views and the performance mart.

The mart reads the base tables (not the staging views). Dimension joins are left joins on
the dimension keys; AQE turns them into broadcast joins when a dimension's measured size is
under the broadcast threshold, and keeps a shuffle join otherwise (dim_title can be large).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.domain import churn_flag, roi_flag


LICENSING_COLUMNS = ("performance_id", "title_id", "region_code", "date_id", "license_cost_usd")


def stg_movies(dim_title: DataFrame) -> DataFrame:
    return dim_title


def stg_user_behavior(fact: DataFrame) -> DataFrame:
    return fact


def stg_licensing(fact: DataFrame) -> DataFrame:
    return fact.select(*LICENSING_COLUMNS)


MART_COLUMNS = (
    "performance_id", "title_id", "title_name", "genre", "release_year", "content_type",
    "region_code", "region_name", "full_date", "year", "quarter", "month", "month_name", "week",
    "day", "total_watch_hours", "unique_viewers", "license_cost_usd", "cost_per_hour_watched",
    "sentiment_score", "churn_rate_post_title", "roi_flag", "high_churn_risk",
)


def content_performance_mart(fact: DataFrame, dim_title: DataFrame, dim_region: DataFrame,
                             dim_date: DataFrame) -> DataFrame:
    """Fact left-joined to title, region and date, with ROI and churn flags."""
    p = fact.alias("p")
    t = dim_title.alias("t")
    r = dim_region.alias("r")
    d = dim_date.alias("d")
    joined = (
        p.join(t, F.col("p.title_id") == F.col("t.title_id"), "left")
        .join(r, F.col("p.region_code") == F.col("r.region_code"), "left")
        .join(d, F.col("p.date_id") == F.col("d.date_id"), "left")
    )
    return joined.select(
        "p.performance_id", "p.title_id", "t.title_name", "t.genre", "t.release_year",
        "t.content_type", "p.region_code", "r.region_name", "d.full_date", "d.year", "d.quarter",
        "d.month", "d.month_name", "d.week", "d.day", "p.total_watch_hours", "p.unique_viewers",
        "p.license_cost_usd", "p.cost_per_hour_watched", "p.sentiment_score",
        "p.churn_rate_post_title",
        roi_flag(F.col("p.cost_per_hour_watched")).alias("roi_flag"),
        churn_flag(F.col("p.churn_rate_post_title")).alias("high_churn_risk"),
    )


def publish_views(spark: SparkSession, database: str) -> None:
    """The three staging models as views in the catalog, over the warehouse tables of ``database``."""
    for view, source, columns in (
        ("stg_movies", "dim_title", ["*"]), ("stg_user_behavior", "fact_content_performance", ["*"]),
        ("stg_licensing", "fact_content_performance", list(LICENSING_COLUMNS)),
    ):
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT {', '.join(columns)} FROM {database}.{source}")


def materialize(spark: SparkSession, name: str, df: DataFrame, kind: str = "view",
                path: str | None = None, database: str | None = None) -> DataFrame:
    """Publish a model as a temp view (``kind='view'``) or as a Parquet table written to
    ``path`` (``kind='table'``, overwritten as a whole): a catalog table with ``database``, else
    a temp view of that path."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        if path is None:
            raise ValueError("a table model needs a path")
        if database:
            df.write.mode("overwrite").option("path", path).saveAsTable(f"{database}.{name}")
            return spark.table(f"{database}.{name}")
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    raise ValueError("kind must be 'view' or 'table'")
