"""Readers and writers for the raw zone (CSV), curated zone (Parquet) and CSV exports.

Raw CSV is read with every column as string (no inference pass over the data; casts happen
once, leniently, in the cleaners). Curated outputs keep Hive-style partition discovery so
filters on partition columns prune folders at planning time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.domain import performance_key
from ..functions.names import snake_case_columns
from ..session import CODEC, path_exists

# Raw file name -> dataset folder.
RAW_DATASETS = {
    "watch_history.csv": "watch_history",
    "movies.csv": "movies",
    "reviews.csv": "reviews",
    "licensing_costs.csv": "licensing",
    "search_logs.csv": "search_logs",
    "users.csv": "users",
    "recommendation_logs.csv": "recommendation_logs",
}


def _csv_writer(df: DataFrame, mode: str):
    """Headered CSV that round-trips text exactly: quotes doubled, blanks kept (Spark trims
    leading and trailing blanks on write unless told not to)."""
    return (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _csv_reader(spark: SparkSession, multiline: bool):
    reader = spark.read.option("header", True).option("inferSchema", False)
    if multiline:
        # Quoted fields may hold newlines; a doubled quote escapes a quote. Such files are
        # not splittable, so parallelism comes from the number of files.
        reader = reader.option("multiLine", True).option("quote", '"').option("escape", '"')
    return reader


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Headered CSV files anywhere below ``path`` (all columns string)."""
    return _csv_reader(spark, multiline).option("recursiveFileLookup", True).csv(path)


def read_raw_zone(spark: SparkSession, root: str, dataset: str, year: int | None = None,
                  month: int | None = None, multiline: bool = False) -> DataFrame:
    """One dataset of the raw zone laid out as ``root/dataset/year=Y/month=MM/*.csv``.

    Partition discovery keeps ``year`` and ``month`` as columns; filtering on them prunes
    folders before any file is opened. A missing dataset is a ``FileNotFoundError``."""
    path = f"{root.rstrip('/')}/{dataset}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"The raw zone has no dataset at {path}")
    df = _csv_reader(spark, multiline).option("basePath", path).csv(path)
    if year is not None:
        df = df.filter(F.col("year") == int(year))
    if month is not None:
        df = df.filter(F.col("month") == int(month))
    return df


def land_raw(df: DataFrame, root: str, dataset: str, year: int, month: int) -> str:
    """Write rows as headered CSV to ``root/dataset/year=Y/month=MM/``, in place of what that month
    held; other months stay. Landing a month again changes nothing."""
    path = f"{root.rstrip('/')}/{dataset}"
    staged = df.withColumn("year", F.lit(int(year))).withColumn("month", F.lpad(F.lit(str(int(month))), 2, "0"))
    _csv_writer(staged, "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").csv(path)
    return path


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated Parquet with partition discovery, names snake-cased."""
    return snake_case_columns(spark.read.parquet(path))


def write_curated(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace one curated dataset. Rows of a partitioned write are first dealt by the partition columns
    (``rebalance``), so the number of files does not grow with the number of tasks; adaptive execution
    splits the share of a hot value again."""
    if partition_by:
        by_partition(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_content_performance(df: DataFrame, path: str) -> None:
    """Partition by *copies* of region and year so the originals stay inside the files. The copies, and ids that are made
    of their row's title, region and year (64 digits that do not pack), are made again after the rows were dealt."""
    slim, columns = df, {c: F.col(c) for c in df.columns}
    if dict(df.dtypes).get("performance_id") == "string" and "title_id" in df.columns:
        made = performance_key(F.col("title_id"), F.col("region"), F.col("year"))
        # an id in a struct, which may be null itself, stands where it is another
        own = F.when(~F.col("performance_id").eqNullSafe(made), F.struct(F.col("performance_id").alias("id")))
        slim = df.withColumn("__own", own).drop("performance_id")
        columns["performance_id"] = F.when(F.col("__own").isNull(), made).otherwise(F.col("__own.id"))
    out = by_partition(slim, ["region", "year"]).select(
        *[c.alias(name) for name, c in columns.items()], F.col("region").alias("region_partition"), F.col("year").alias("year_partition"))
    out.write.mode("overwrite").option("compression", CODEC).partitionBy("region_partition", "year_partition").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV, replaced as a whole."""
    _csv_writer(df, "overwrite").csv(path)
