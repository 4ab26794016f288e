"""Whole jobs: clean each raw dataset, build content performance, load the warehouse,
publish the models and check quality. Jobs read and write; everything between is lazy
DataFrame code from ``operators``.

Lineage is cut where a result is used twice: the content-performance result is written to the
shared scratch folder before the licence gate and the final write, so neither recomputes the joins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaners
from ..operators.metrics import check_licence_gate, content_performance, licence_gate_counts
from ..operators.models import content_performance_mart, materialize, publish_views, stg_licensing, stg_movies, stg_user_behavior
from ..operators.quality import check_all
from ..operators.warehouse import Warehouse, load_staging
from ..session import stored
from ..sources.files import read_curated, read_raw_csv, write_content_performance, write_curated

CURATED_FOLDERS = {
    "watch_history": "watch_history",
    "movies": "movies",
    "reviews": "sentiment",
    "licensing": "licensing",
    "search_logs": "search_logs",
    "users": "users",
    "recommendation_logs": "recommendation_logs",
}


@dataclass
class JobPaths:
    """Where a job reads and writes. An explicit path beats one derived from a zone root."""

    raw_root: str | None = None
    curated_root: str | None = None
    explicit: dict[str, str] = field(default_factory=dict)

    def resolve(self, key: str, root: str | None, folder: str) -> str:
        if self.explicit.get(key):
            return self.explicit[key]
        if root:
            return f"{root.rstrip('/')}/{folder}/"
        raise ValueError(f"No path for {key!r}: give an explicit path or a zone root")

    def raw(self, dataset: str) -> str:
        return self.resolve(f"raw:{dataset}", self.raw_root, dataset)

    def curated(self, dataset: str) -> str:
        return self.resolve(f"curated:{dataset}", self.curated_root, CURATED_FOLDERS.get(dataset, dataset))


def run_clean(spark: SparkSession, paths: JobPaths, dataset: str) -> DataFrame:
    """Read one raw dataset, clean it, overwrite its curated folder; returns the cleaned
    DataFrame (lazy view of what was written)."""
    registry = {folder: fn for folder, fn in cleaners.DATASETS.values()}
    cleaner = registry[dataset]
    raw = read_raw_csv(spark, paths.raw(dataset), multiline=(dataset == "reviews"))
    cleaned = cleaner(raw)
    out = paths.curated(dataset)
    write_curated(cleaned, out, ["region"] if dataset == "search_logs" else None)
    return spark.read.parquet(out)


def run_content_performance(spark: SparkSession, paths: JobPaths, output: str | None = None,
                            how: str = "inner") -> DataFrame:
    """Curated watch history, licensing, movies and sentiment -> content performance,
    partitioned by copies of region and year. Raises before writing when usage could not
    be costed."""
    watch = read_curated(spark, paths.curated("watch_history"))
    result = content_performance(
        watch,
        read_curated(spark, paths.curated("licensing")),
        read_curated(spark, paths.curated("movies")),
        read_curated(spark, paths.curated("reviews")),
        how=how,
        reduce_usage=True,  # licensing is a stored table here, so that reading it again is cheap
    )
    result = stored(result, "content-performance")
    counts = licence_gate_counts(result).first()
    usage_rows = watch.filter(F.col("title_id").isNotNull()).limit(1).count()
    check_licence_gate(counts["row_count"], counts["licensed_row_count"], usage_rows)
    out = output or paths.curated("content_performance")
    write_content_performance(result, out)
    return spark.read.parquet(out)


def run_warehouse_load(spark: SparkSession, curated_content_performance: str, warehouse_root: str,
                       database: str | None = None, churn: DataFrame | None = None) -> dict[str, int]:
    """Create the star schema if absent, then append new dims and facts."""
    wh = Warehouse(spark, warehouse_root, database)
    wh.create()
    staging = load_staging(spark.read.parquet(curated_content_performance), churn=churn)
    return wh.load(stored(staging, "staging"))


def run_models(spark: SparkSession, warehouse_root: str, mart_path: str, database: str | None = None) -> DataFrame:
    """Staging views and the mart table, over the warehouse's named sources. With ``database`` they are
    catalog objects that outlive the session, else temporary views."""
    sources = Warehouse(spark, warehouse_root, database).sources()
    fact, title, region, date = (sources[n] for n in ("fact_content_performance", "dim_title", "dim_region", "dim_date"))
    if database:
        publish_views(spark, database)
    else:
        materialize(spark, "stg_movies", stg_movies(title))
        materialize(spark, "stg_user_behavior", stg_user_behavior(fact))
        materialize(spark, "stg_licensing", stg_licensing(fact))
    return materialize(spark, "content_performance", content_performance_mart(fact, title, region, date),
                       kind="table", path=mart_path, database=database)


def run_quality(spark: SparkSession, warehouse_root: str, min_rows: int = 1000) -> DataFrame:
    wh = Warehouse(spark, warehouse_root)
    return check_all(wh.table("fact_content_performance"), wh.table("dim_title"), wh.table("dim_region"),
                     wh.table("dim_date"), min_rows=min_rows)


def run_pipeline(spark: SparkSession, raw_root: str, curated_root: str, warehouse_root: str,
                 mart_path: str) -> DataFrame:
    """Seven cleaners, the join job, the warehouse load, the models; returns the quality
    report."""
    paths = JobPaths(raw_root=raw_root, curated_root=curated_root)
    for _, (folder, _) in cleaners.DATASETS.items():
        run_clean(spark, paths, folder)
    cp_path = paths.curated("content_performance")
    run_content_performance(spark, paths, cp_path)
    run_warehouse_load(spark, cp_path, warehouse_root)
    run_models(spark, warehouse_root, mart_path)
    return run_quality(spark, warehouse_root)
