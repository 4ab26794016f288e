"""Star-schema load: staging, dimensions and fact, insert-if-absent.

Pure functions compute the rows to add (``new_*_rows``) from the staging data and the
current table; ``Warehouse`` stores the four tables as Parquet folders under one root (shared
storage) and appends those rows. Every insert is "rows whose key is absent", a left-anti join
that Spark plans as a hash (or, when AQE measures a small side, broadcast) anti join, so a
repeated or resumed run adds nothing twice. There are no transactions on plain Parquet:
dimensions are appended before the fact, each step idempotent (a failed run is re-run).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import cast_column
from ..functions.domain import blank_to_unknown, date_key
from ..functions.names import snake_case_columns
from ..session import CODEC, path_exists

# ---------------------------------------------------------------------------
# Table contracts and the region seed.
# ---------------------------------------------------------------------------
STAGING_SCHEMA = T.StructType([
    T.StructField("performance_id", T.StringType()),
    T.StructField("title_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("total_watch_hours", T.DoubleType()),
    T.StructField("churn_rate_post_title", T.DoubleType()),
    T.StructField("unique_viewers", T.LongType()),
    T.StructField("license_region", T.StringType()),
    T.StructField("license_cost_usd", T.DoubleType()),
    T.StructField("license_year", T.IntegerType()),
    T.StructField("title_name", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("secondary_genre", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("duration_minutes", T.DoubleType()),
    T.StructField("rating", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("country_of_origin", T.StringType()),
    T.StructField("imdb_rating", T.DoubleType()),
    T.StructField("is_netflix_original", T.BooleanType()),
    T.StructField("added_to_platform", T.DateType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("cost_per_hour_watched", T.DoubleType()),
])
DIM_TITLE_SCHEMA = T.StructType([
    T.StructField("title_id", T.StringType(), False),
    T.StructField("title_name", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("secondary_genre", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("duration_minutes", T.DecimalType(10, 2)),
    T.StructField("rating", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("country_of_origin", T.StringType()),
    T.StructField("imdb_rating", T.DecimalType(4, 2)),
    T.StructField("is_netflix_original", T.BooleanType()),
    T.StructField("added_to_platform", T.DateType()),
    T.StructField("popularity", T.DecimalType(18, 6)),
])
DIM_REGION_SCHEMA = T.StructType([
    T.StructField("region_code", T.StringType(), False),
    T.StructField("region_name", T.StringType()),
])
DIM_DATE_SCHEMA = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("week", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
])
FACT_SCHEMA = T.StructType([
    T.StructField("performance_id", T.StringType(), False),
    T.StructField("title_id", T.StringType(), False),
    T.StructField("region_code", T.StringType(), False),
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("total_watch_hours", T.DecimalType(18, 2)),
    T.StructField("unique_viewers", T.LongType()),
    T.StructField("license_cost_usd", T.DecimalType(18, 2)),
    T.StructField("cost_per_hour_watched", T.DecimalType(18, 4)),
    T.StructField("sentiment_score", T.DecimalType(6, 5)),
    T.StructField("churn_rate_post_title", T.DecimalType(6, 5)),
])
REGION_SEED = [
    ("US", "United States"),
    ("CA", "Canada"),
    ("GB", "United Kingdom"),
    ("IN", "India"),
    ("BR", "Brazil"),
    ("MX", "Mexico"),
    ("DE", "Germany"),
    ("JP", "Japan"),
    ("UNKNOWN", "Unknown"),
]
# Calendar attributes of the one-row-per-year date dimension are constants, not derived.
DATE_CONSTANTS = {"quarter": 1, "month": 1, "month_name": "January", "week": 1, "day": 1, "day_of_week": 1}
TABLE_SCHEMAS = {
    "dim_title": DIM_TITLE_SCHEMA,
    "dim_region": DIM_REGION_SCHEMA,
    "dim_date": DIM_DATE_SCHEMA,
    "fact_content_performance": FACT_SCHEMA,
}
# ---------------------------------------------------------------------------

COST_SCALE = 1_000_000


def _project(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_staging(curated: DataFrame, churn: DataFrame | None = None, cost_scale: float = COST_SCALE) -> DataFrame:
    """Curated content performance -> the 25-column staging shape, matched **by name**.

    Curated cost columns are in millions of USD; the warehouse is in USD, so
    ``license_cost_usd = license_cost_usd_millions * cost_scale`` and the cost per hour is
    scaled the same way. ``churn_rate_post_title`` comes from the input if present, else from
    ``churn`` (title_id, region, year, churn_rate_post_title) if given, else null."""
    df = snake_case_columns(curated)
    cols = {}
    in_millions = "license_cost_usd_millions" in df.columns
    for field in STAGING_SCHEMA.fields:
        name, target = field.name, field.dataType.simpleString()
        if name == "license_cost_usd" and in_millions and name not in df.columns:
            cols[name] = cast_column(df, "license_cost_usd_millions", "double") * F.lit(float(cost_scale))
        elif name == "cost_per_hour_watched" and in_millions and name in df.columns:
            cols[name] = cast_column(df, name, "double") * F.lit(float(cost_scale))
        elif name in df.columns:
            cols[name] = cast_column(df, name, target)
        else:
            cols[name] = F.lit(None).cast(field.dataType)
    staged = df.select(*[c.alias(n) for n, c in cols.items()])
    if churn is not None and "churn_rate_post_title" not in df.columns:
        ch = churn.select(
            F.col("title_id").alias("__t"), F.col("region").alias("__r"), F.col("year").alias("__y"),
            F.col("churn_rate_post_title").cast("double").alias("__churn"),
        )
        staged = (
            staged.join(
                ch,
                (staged.title_id == ch.__t) & (staged.region == ch.__r) & staged.year.eqNullSafe(ch.__y),
                "left",
            )
            .withColumn("churn_rate_post_title", F.col("__churn"))
            .select(*[f.name for f in STAGING_SCHEMA.fields])
        )
    return staged


def title_rollup(staging: DataFrame) -> DataFrame:
    """One row per title_id: independent MAX of each attribute (values from different rows
    may mix); the original flag is true when any row says true (null counts as false)."""
    m = {c: F.max(c).alias(c) for c in [f.name for f in DIM_TITLE_SCHEMA.fields[1:]]}
    m["is_netflix_original"] = F.coalesce(F.bool_or("is_netflix_original"), F.lit(False)).alias(
        "is_netflix_original"
    )
    rolled = staging.filter(F.col("title_id").isNotNull()).groupBy("title_id").agg(*m.values())
    return _project(rolled, DIM_TITLE_SCHEMA)


def seed_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGION_SEED, DIM_REGION_SCHEMA)


def region_rows(staging: DataFrame) -> DataFrame:
    code = blank_to_unknown(F.col("region"))
    return staging.select(code.alias("region_code"), code.alias("region_name")).distinct()


def date_rows(staging: DataFrame) -> DataFrame:
    years = staging.filter(F.col("year").isNotNull()).select("year").distinct()
    return _project(
        years.select(
            date_key(F.col("year")).alias("date_id"),
            F.make_date(F.col("year"), F.lit(1), F.lit(1)).alias("full_date"),
            F.col("year"),
            *[F.lit(v).alias(k) for k, v in DATE_CONSTANTS.items()],
        ),
        DIM_DATE_SCHEMA,
    )


def fact_rows(staging: DataFrame) -> DataFrame:
    keep = F.col("performance_id").isNotNull() & F.col("title_id").isNotNull() & F.col("year").isNotNull()
    return _project(
        staging.filter(keep).select(
            "performance_id",
            "title_id",
            blank_to_unknown(F.col("region")).alias("region_code"),
            date_key(F.col("year")).alias("date_id"),
            "total_watch_hours",
            "unique_viewers",
            "license_cost_usd",
            "cost_per_hour_watched",
            "sentiment_score",
            "churn_rate_post_title",
        ),
        FACT_SCHEMA,
    )


def absent(rows: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Rows whose ``key`` is not in ``existing`` (NOT EXISTS as a left-anti join)."""
    if existing is None:
        return rows
    return rows.join(existing.select(key), key, "left_anti")


def new_dim_title_rows(staging: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Titles not yet in dim_title; existing titles are never updated."""
    return absent(title_rollup(staging), existing, "title_id")


def new_dim_region_rows(staging: DataFrame, existing: DataFrame | None) -> DataFrame:
    return absent(region_rows(staging), existing, "region_code")


def new_seed_region_rows(spark: SparkSession, existing: DataFrame | None) -> DataFrame:
    return absent(seed_regions(spark), existing, "region_code")


def new_dim_date_rows(staging: DataFrame, existing: DataFrame | None) -> DataFrame:
    return absent(date_rows(staging), existing, "date_id")


def new_fact_rows(staging: DataFrame, existing: DataFrame | None, dedupe: bool = False) -> DataFrame:
    """Facts whose performance_id is absent. Duplicates inside one batch are all inserted
    (data quality reports them) unless ``dedupe`` keeps one per id."""
    rows = fact_rows(staging)
    if dedupe:
        from .dedupe import keep_first

        rows = keep_first(rows, ["performance_id"])
    return absent(rows, existing, "performance_id")


class Warehouse:
    """Four Parquet tables under ``root`` (a shared folder), append-only.

    ``create()`` makes the empty typed tables and seeds dim_region; ``load(staging)`` appends
    the new dimension rows, then the new facts. Optionally registers catalog tables
    ``{database}.{table}`` over the same locations."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(self.path(name))

    def _append(self, df: DataFrame, name: str, sort_by: list[str] | None = None) -> int:
        """Append ``df`` and return how many rows were written, observed during the write
        itself (no second pass over the data or the table)."""
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
        seen = Observation(f"append_{name}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").option("compression", CODEC).parquet(self.path(name))
        return int(seen.get.get("rows", 0))

    def create(self) -> None:
        for name, schema in TABLE_SCHEMAS.items():
            if not path_exists(self.spark, self.path(name)):
                self.spark.createDataFrame([], schema).write.parquet(self.path(name))
        seed = new_seed_region_rows(self.spark, self.table("dim_region"))
        if not seed.isEmpty():
            self._append(seed, "dim_region", ["region_code"])
        if self.database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
            for name in TABLE_SCHEMAS:
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {self.database}.{name} USING parquet "
                    f"LOCATION '{self.path(name)}'"
                )

    def sources(self) -> dict[str, DataFrame]:
        """Named source tables for the models (catalog tables when registered)."""
        if self.database:
            return {n: self.spark.table(f"{self.database}.{n}") for n in TABLE_SCHEMAS}
        return {n: self.table(n) for n in TABLE_SCHEMAS}

    def load(self, staging: DataFrame, dedupe_facts: bool = False, tables: Sequence[str] = tuple(TABLE_SCHEMAS)) -> dict[str, int]:
        """Append new dims, then new facts, those of ``tables``. Returns rows appended per table.

        ``staging`` is read several times; pass a materialised (written or checkpointed)
        staging DataFrame so upstream work is not recomputed per table. Fact files are sorted
        by (date, region, title), so that row groups can be skipped; facts stay in the tasks that found
        them new, since ids are long and another shuffle of them costs as much as the files."""
        added = {}
        steps = [
            ("dim_title", lambda: new_dim_title_rows(staging, self.table("dim_title")), ["title_id"]),
            ("dim_region", lambda: new_dim_region_rows(staging, self.table("dim_region")), ["region_code"]),
            ("dim_date", lambda: new_dim_date_rows(staging, self.table("dim_date")), ["date_id"]),
            (
                "fact_content_performance",
                lambda: new_fact_rows(staging, self.table("fact_content_performance"), dedupe_facts),
                ["date_id", "region_code", "title_id"],
            ),
        ]
        for name, rows, sort_by in steps:
            if name in tables:
                added[name] = self._append(rows(), name, sort_by)
        return added

