"""Licence preparation and the as-of licence pick.

For every usage group (title_id, region, year) exactly one licence of the same title is kept,
by this total order:

1. licence year equal to the usage year;
2. else the nearest earlier licence year;
3. else the nearest later licence year (when the usage year is null: the latest licence year);
4. else an undated licence;
then, among the licences of the chosen year, the one whose region equals the usage region,
else the smallest licence region; then the smallest cost. Titles without any licence drop
out (``how="inner"``) or keep null licence columns (``how="left"``).

Plan (no pair emission, no join, one shuffle)
---------------------------------------------
A join of usage and licences on the title alone followed by ``row_number`` multiplies every
usage group by every licence of its title. Instead:

* licences are reduced once to ``exact`` = (title, year, region) -> smallest cost (hash
  aggregation with map-side partial aggregation);
* usage groups and ``exact`` rows are unioned and shuffled **once** by title. Three windows
  follow, all clustered by title, so Spark only re-sorts locally between them:
  - windows 1 and 2, per title by year, are the **as-of join**: ``last(..., ignorenulls)`` over
    the licence rows looking back gives the exact-or-earlier year; the same over the reversed
    order gives the later one (undated licences sort after everything, so they are reached only
    when no dated year exists). In both orders the licences of a year stand by region, the
    smallest last, so that the one looked up is the fallback licence of its year;
  - window 3, per (title, region) by year, looks back from each usage row, placed at its
    chosen year, to the licence row of its own region: if that row has the chosen year, the
    usage region is preferred.
Every row is sorted three times, so it carries little: the licence as one struct that is null on
usage rows, and one number for its place among rows of a year.
A title partition holds its (region, year) licences and its (region, year) usage groups, all
aggregated, so even a title with a third of all plays is a small partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import cast_column
from ..functions.domain import normalize_region
from ..functions.names import snake_case_columns

def prepare_licensing(curated: DataFrame) -> DataFrame:
    """Curated licensing -> (title_id, license_region normalised, cost in millions, year)."""
    df = snake_case_columns(curated)
    return df.select(
        F.col("title_id").cast("string").alias("title_id"),
        normalize_region(F.col("region")).alias("license_region"),
        cast_column(df, "license_cost_usd_millions", "double").alias("license_cost_usd_millions"),
        cast_column(df, "license_year", "int").alias("license_year"),
    )


def pick_license(usage: DataFrame, licensing: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the best licence to every usage group (see module docstring).

    ``usage`` needs title_id, region, year (other columns pass through);
    ``licensing`` is the output of ``prepare_licensing``.
    Returns usage columns + license_region, license_cost_usd_millions, license_year.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    cost = F.col("license_cost_usd_millions")
    # min() skips nulls, which is "smallest cost, nulls last" for one column.
    exact = licensing.groupBy("title_id", "license_year", "license_region").agg(F.min(cost).alias("__cost"))
    # Places among rows of one year: a dated licence (0) before usage (1); an undated licence (2)
    # after every usage row, null-year usage included.
    lic_rows = exact.select(
        "title_id",
        F.col("license_region").alias("region"),
        F.col("license_year").alias("year"),
        F.when(F.col("license_year").isNull(), F.lit(2)).otherwise(F.lit(0)).alias("__slot"),
        F.struct(
            F.col("license_year").alias("year"), F.col("license_region").alias("region"), F.col("__cost").alias("cost")
        ).alias("__lic"),
    )
    # The one shuffle: every window below is clustered by title, so hash partitioning by
    # title satisfies all three and Spark only sorts locally between them. The number of partitions is
    # named, so that adaptive execution, which goes by shuffled bytes, does not put tasks together:
    # rows of some 20 bytes in the shuffle take over 500 in the sorts of a task.
    partitions = int(usage.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = usage.withColumn("__slot", F.lit(1)).unionByName(lic_rows, allowMissingColumns=True).repartition(partitions, "title_id")
    is_lic = F.col("__slot") != 1
    so_far = (Window.unboundedPreceding, Window.currentRow)

    # Windows 1 and 2: the chosen licence year per usage row, and the fallback licence of that year.
    in_title = Window.partitionBy("title_id").orderBy(
        F.col("year").asc_nulls_last(), F.col("__slot"), F.col("region").desc_nulls_first())
    # Ahead is behind in the reversed order: a growing frame is updated row by row, whereas one that
    # shrinks towards the end would be read again for every row.
    reversed_title = Window.partitionBy("title_id").orderBy(
        F.col("year").desc_nulls_first(), F.col("__slot").desc(), F.col("region").desc_nulls_first())
    rows = rows.withColumn("__back", F.last("__lic", ignorenulls=True).over(in_title.rowsBetween(*so_far)))
    rows = rows.withColumn("__back", F.when(~is_lic, F.col("__back")))
    ahead = F.last("__lic", ignorenulls=True).over(reversed_title.rowsBetween(*so_far))
    rows = rows.withColumn("__ahead", ahead).withColumn(
        "__pick", F.when(~is_lic, F.coalesce("__back", "__ahead"))).drop("__back", "__ahead")
    if how == "inner":
        rows = rows.filter(is_lic | F.col("__pick").isNotNull())

    # Window 3: per (title, region), usage rows sit at their chosen year after the licence
    # rows of that year; looking back finds the same-region licence of that year if any.
    slot_year = F.when(is_lic, F.col("year")).otherwise(F.col("__pick.year"))
    in_region = Window.partitionBy("title_id", "region").orderBy(slot_year.asc_nulls_last(), ~is_lic)
    rows = rows.withColumn("__prior", F.last("__lic", ignorenulls=True).over(in_region.rowsBetween(*so_far))).filter(~is_lic)
    same_year = F.col("__prior").isNotNull() & F.col("__prior.year").eqNullSafe(F.col("__pick.year"))
    return rows.select(
        *usage.columns,
        F.when(same_year, F.col("region")).otherwise(F.col("__pick.region")).alias("license_region"),
        F.when(same_year, F.col("__prior.cost")).otherwise(F.col("__pick.cost")).alias("license_cost_usd_millions"),
        F.col("__pick.year").alias("license_year"),
    )


def pick_license_spread(usage: DataFrame, licensing: DataFrame, how: str = "inner") -> DataFrame:
    """:func:`pick_license` for titles of very many regions: no task holds the groups of a whole title.

    Which year's licence is taken depends on title and usage year alone. So the windows of ``pick_license`` run over a
    title's distinct years, at most a few thousand, with one licence a year (its smallest region, then cost).
    Usage then meets its year's choice by (title, year), and the licence of its own region in the chosen year by
    (title, region, year): joins whose keys spread a title over many tasks. Two shuffles of usage in place
    of one. ``usage`` and ``licensing`` are read twice; pass stored ones."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    exact = licensing.groupBy("title_id", "license_year", "license_region").agg(F.min("license_cost_usd_millions").alias("__cost"))
    region, cost = F.col("license_region"), F.col("__cost")
    smallest = F.min(F.struct(region.isNull().alias("a"), region.alias("region"), cost.isNull().alias("b"), cost.alias("cost")))
    yearly = exact.groupBy("title_id", "license_year").agg(smallest.alias("__l")).select(
        "title_id", F.col("__l.region").alias("license_region"), F.col("__l.cost").alias("license_cost_usd_millions"), "license_year")
    years = usage.select("title_id", F.lit(None).cast("string").alias("region"), "year").distinct()
    chosen = pick_license(years, yearly).select(
        F.col("title_id").alias("__t"), F.col("year").alias("__u"), F.col("license_region").alias("__r"),
        F.col("license_cost_usd_millions").alias("__c"), F.col("license_year").alias("__y"))
    own = exact.select(F.col("title_id").alias("__ot"), F.col("license_region").alias("__or"),
                       F.col("license_year").alias("__oy"), F.col("__cost").alias("__oc"), F.lit(True).alias("__own"))
    rows = usage.join(chosen, (F.col("title_id") == F.col("__t")) & F.col("year").eqNullSafe(F.col("__u")), how)
    rows = rows.join(own, (F.col("__t") == F.col("__ot")) & F.col("region").eqNullSafe(F.col("__or"))
                     & F.col("__y").eqNullSafe(F.col("__oy")), "left")
    return rows.select(
        *usage.columns,
        F.when(F.col("__own"), F.col("region")).otherwise(F.col("__r")).alias("license_region"),
        F.when(F.col("__own"), F.col("__oc")).otherwise(F.col("__c")).alias("license_cost_usd_millions"),
        F.col("__y").alias("license_year"))
