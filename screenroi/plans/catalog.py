"""Registered queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query starts from the given tables through ``sources.bindings`` and runs over all of
their rows. ``Flow`` builds the shared stages lazily (nothing is computed until an action),
so one query's plan contains exactly the stages it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.domain import SERIES_WORDS_WIDE, content_type, guarded_ratio, normalize_region, performance_key
from ..operators import cleaners
from ..operators.incremental import FactStore, order_breaks, write_bucketed
from ..operators.licensing import pick_license, pick_license_spread, prepare_licensing
from ..operators.metrics import (
    NO_YEAR, conform, content_performance, licence_gate_counts, licensed_plays, prepare_usage, usage_by_title_region_year,
)
from ..operators.models import content_performance_mart, publish_views, stg_licensing, stg_movies, stg_user_behavior
from ..operators.quality import DIMENSIONS, check_all, duplicate_keys, referential_checks
from ..operators.titles import distinct_title_ids, license_grid, normalize_titles, title_ids_from_first
from ..operators.upsert import CuratedStore
from ..operators.viewers import ERROR, roll_up, viewer_sketches
from ..operators.warehouse import (
    Warehouse, load_staging, new_dim_date_rows, new_dim_region_rows, new_dim_title_rows,
    new_fact_rows, seed_regions, title_rollup,
)
from ..session import file_stamps, scratch_path, scratch_root, size_shuffles, stored
from ..sources import bindings as b
from ..sources.events import land_play_events, read_play_events
from ..sources.files import (
    land_raw, read_curated, read_raw_csv, read_raw_zone, write_content_performance, write_csv, write_curated,
)
from ..streaming.usage import (
    events_to_watch, read_latest, rows_dropped, start_daily_usage_stream, start_usage_refresh, start_windowed_usage, window_plays,
)

# Fixed test inputs for the scalar-mapping queries: spellings assigned to rows by key.
REGION_SPELLINGS_SAMPLE = (
    " usa ", "United Kingdom", "gb", "", None, "Canada", "united states of america",
    "INDIA", "brazil ", "Mexico", "germany", "Japan",
)
TYPE_SPELLINGS_SAMPLE = ("TV", " tv show ", "Miniseries", "series", None, "show")


#: The tables that flows join and group; the others are narrow, or reduced where they are read.
READ = {f"{t}.parquet" for t in ("customer", "supplier", "part", "orders", "lineitem", "events")}

#: What usage and churn read of the cleaned watch history.
PLAY_COLUMNS = ("title_id", "region", "watch_date", "user_id", "watch_duration_mins", "action")

#: What was written once, by session, input files and name.
_BUILT: dict[tuple[Any, ...], Any] = {}


class Flow:
    """Lazy stages of the whole pipeline for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, fresh: bool = False):
        """``fresh`` builds everything anew, also what this session has written before."""
        self.spark = spark
        self.t = b.Tables(spark, sf_dir)
        self.fresh = fresh
        #: How many tasks the input makes, however many the session was set to.
        self.tasks = size_shuffles(spark, sum(size for name, size, _ in self.stamps if READ & set(name.split("/"))))

    @cached_property
    def stamps(self) -> tuple[tuple[str, int, int], ...]:
        return file_stamps(self.spark, self.t.sf_dir)

    # -- cleaned datasets ------------------------------------------------------------
    @cached_property
    def watch(self) -> DataFrame:
        return cleaners.clean_watch_history(b.watch_history_raw(self.t))

    @cached_property
    def plays(self) -> DataFrame:
        """``watch`` up to the last column that usage and churn read."""
        return cleaners.clean_watch_history(b.watch_history_raw(self.t), last="region")

    @cached_property
    def licensing(self) -> DataFrame:
        return cleaners.clean_licensing(b.licensing_raw(self.t))

    @cached_property
    def movies(self) -> DataFrame:
        return cleaners.clean_movies(b.movies_raw(self.t))

    @cached_property
    def sentiment(self) -> DataFrame:
        return cleaners.clean_review_sentiment(b.reviews_raw(self.t))

    # -- metrics -----------------------------------------------------------------------
    @cached_property
    def usage(self) -> DataFrame:
        return usage_by_title_region_year(prepare_usage(self.plays))

    @cached_property
    def licensed(self) -> DataFrame:
        return pick_license(self.usage, prepare_licensing(self.licensing))

    @cached_property
    def content_performance(self) -> DataFrame:
        return content_performance(self.plays, self.licensing, self.movies, self.sentiment)

    # -- warehouse -----------------------------------------------------------------------
    @cached_property
    def curated_watch(self) -> DataFrame:
        """The columns of the cleaned watch history that usage and the churn input read, written once for both."""
        return stored(self.plays.select(*PLAY_COLUMNS), "watch")

    @cached_property
    def staging(self) -> DataFrame:
        """Written once per session and folder: it feeds every warehouse query."""
        def build() -> DataFrame:
            cp = content_performance(self.curated_watch, self.licensing, self.movies, self.sentiment,
                                     churn=b.churn_input(self.curated_watch, NO_YEAR))
            staged = load_staging(cp)
            # ids are nine tenths of what would be written, and made of three columns: made again by who reads them
            kept = stored(staged.drop("performance_id"), "staging")
            return kept.withColumn("performance_id", performance_key(F.col("title_id"), F.col("region"), F.col("year"))).select(*staged.columns)

        return self._once("staging", build)

    def _once(self, name: str, build: Callable[[], Any]) -> Any:
        """Built once a session for the same input files (names, sizes and times)."""
        key = (self.spark.sparkContext.applicationId, self.t.sf_dir, self.stamps, name)
        if self.fresh or key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]

    @cached_property
    def dim_region(self) -> DataFrame:
        seed = seed_regions(self.spark)
        return seed.unionByName(new_dim_region_rows(self.staging, seed))

    @cached_property
    def dim_date(self) -> DataFrame:
        return new_dim_date_rows(self.staging, None)

    @cached_property
    def fact(self) -> DataFrame:
        return new_fact_rows(self.staging, None)

    # -- the loaded star schema (written once to the shared scratch folder) ----------------
    @cached_property
    def dimensions(self) -> Warehouse:
        """Create the four tables and load the dimensions, once per session and folder."""
        def build() -> Warehouse:
            wh = Warehouse(self.spark, scratch_path(self.spark, "warehouse"))
            wh.create()
            wh.load(self.staging, tables=DIMENSIONS)
            return wh

        return self._once("dimensions", build)

    @cached_property
    def warehouse(self) -> Warehouse:
        """The same with the facts, which come after the dimensions."""
        def build() -> Warehouse:
            self.dimensions.load(self.staging, tables=["fact_content_performance"])
            return self.dimensions

        return self._once("warehouse", build)

    @cached_property
    def reloaded(self) -> Warehouse:
        """Two loads that overlap."""
        def build() -> Warehouse:
            wh = Warehouse(self.spark, scratch_path(self.spark, "warehouse-reloaded"))
            for batch in self.batches:
                wh.create()
                wh.load(batch)
            return wh

        return self._once("reloaded", build)

    @cached_property
    def batches(self) -> list[DataFrame]:
        """Two batches that overlap: the years up to 1995, then everything."""
        return [self.staging.filter(F.col("year") <= 1995), self.staging]

    def table(self, name: str) -> DataFrame:
        return (self.dimensions if name in DIMENSIONS else self.warehouse).table(name)

    @cached_property
    def loaded_mart(self) -> DataFrame:
        return content_performance_mart(
            self.table("fact_content_performance"), self.table("dim_title"),
            self.table("dim_region"), self.table("dim_date"),
        )


def _flow(spark: SparkSession, sf_dir: str) -> Flow:
    scratch_root(spark)  # reliable checkpoints go to the shared scratch folder
    return Flow(spark, sf_dir)


# -- cleaners -----------------------------------------------------------------------------
def q_clean_licensing(spark, sf_dir):
    return _flow(spark, sf_dir).licensing


def q_clean_movies(spark, sf_dir):
    return _flow(spark, sf_dir).movies


def q_clean_users(spark, sf_dir):
    return cleaners.clean_users(b.users_raw(b.Tables(spark, sf_dir)))


def q_clean_watch_history(spark, sf_dir):
    return _flow(spark, sf_dir).watch


def q_clean_recommendation_logs(spark, sf_dir):
    return cleaners.clean_recommendation_logs(b.recommendation_logs_raw(b.Tables(spark, sf_dir)))


def q_clean_search_logs(spark, sf_dir):
    return cleaners.clean_search_logs(b.search_logs_raw(b.Tables(spark, sf_dir)))


def q_review_sentiment(spark, sf_dir):
    return _flow(spark, sf_dir).sentiment


# -- scalar mappings over table rows -----------------------------------------------------
def _pick(key, values):
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def q_normalize_region(spark, sf_dir):
    c = b.Tables(spark, sf_dir).customer
    raw = c.select(_pick(F.col("c_custkey"), REGION_SPELLINGS_SAMPLE).alias("raw_region"))
    return raw.groupBy("raw_region").agg(F.count(F.lit(1)).alias("n")).select(
        "raw_region", normalize_region(F.col("raw_region")).alias("region"), "n"
    )


def q_content_type_map(spark, sf_dir):
    p = b.Tables(spark, sf_dir).part
    raw = p.select(
        F.when(F.col("p_size") % 7 == 6, F.col("p_type"))
        .otherwise(_pick(F.col("p_size"), TYPE_SPELLINGS_SAMPLE)).alias("raw_type")
    )
    return raw.groupBy("raw_type").agg(F.count(F.lit(1)).alias("n")).select(
        "raw_type",
        content_type(F.col("raw_type")).alias("content_type"),
        content_type(F.col("raw_type"), SERIES_WORDS_WIDE, trim=True).alias("content_type_wide"),
        "n",
    )


# -- usage, licence pick, content performance --------------------------------------------
def q_usage_by_title_region_year(spark, sf_dir):
    return _flow(spark, sf_dir).usage


def q_usage_fractional_minutes(spark, sf_dir):
    """Minutes with small fractions: a sum of rounded minutes would be off."""
    return usage_by_title_region_year(prepare_usage(b.fractional_watch(b.Tables(spark, sf_dir))))


def q_license_pick(spark, sf_dir):
    return _flow(spark, sf_dir).licensed


def q_license_pick_spread(spark, sf_dir):
    """The same pick with every title spread over its years and regions."""
    f = _flow(spark, sf_dir)
    # both are read twice
    return pick_license_spread(stored(f.usage, "usage"), stored(prepare_licensing(f.licensing), "licences"))


def q_usage_licensed_only(spark, sf_dir):
    """The pick over usage of titles that may be licensed: the others leave before the usage shuffles."""
    f = _flow(spark, sf_dir)
    licences = prepare_licensing(f.licensing)
    return pick_license(usage_by_title_region_year(licensed_plays(prepare_usage(f.plays), licences)), licences)


def q_content_performance_core(spark, sf_dir):
    lic = _flow(spark, sf_dir).licensed
    return lic.select(
        "title_id", "region", "year", "total_watch_hours", "unique_viewers", "license_region",
        "license_cost_usd_millions", "license_year",
        guarded_ratio(F.col("license_cost_usd_millions"), F.col("total_watch_hours")).alias("cost_per_hour_watched"),
        performance_key(F.col("title_id"), F.col("region"), F.col("year")).alias("performance_id"),
    )


def q_content_performance(spark, sf_dir):
    return _flow(spark, sf_dir).content_performance


def q_output_conformance(spark, sf_dir):
    return conform(_flow(spark, sf_dir).licensed)


def q_licence_gate(spark, sf_dir):
    """The one-row summary the job checks before writing (rows, rows with a cost)."""
    return licence_gate_counts(_flow(spark, sf_dir).content_performance)


# -- warehouse load ------------------------------------------------------------------------
def q_staging_load(spark, sf_dir):
    return _flow(spark, sf_dir).staging


def q_dim_title_rollup(spark, sf_dir):
    """Over rows whose attributes differ within a title, so that maxima come from different rows."""
    year = F.coalesce("year", F.lit(0))
    return title_rollup(_flow(spark, sf_dir).staging.withColumns({
        "title_name": F.concat_ws(" ", "title_name", "region"),
        "popularity": F.col("popularity") + year % 7,
        "is_netflix_original": year % 2 == 0,
        "genre": F.when(F.col("year") % 3 == 0, F.col("genre")),
    }))


def q_dim_title_insert_if_absent(spark, sf_dir):
    """Two loads: one region's years up to 1995 first, then everything. Titles of the first load keep their
    first values (never updated); the second load adds only unseen titles."""
    st = _flow(spark, sf_dir).staging
    first = new_dim_title_rows(st.filter((F.col("year") <= 1995) & (F.col("region") == "ASIA")), None)
    second = new_dim_title_rows(st, first)
    return first.withColumn("load", F.lit(1)).unionByName(second.withColumn("load", F.lit(2)))


def q_dim_region_load(spark, sf_dir):
    return _flow(spark, sf_dir).dim_region


def q_dim_date_load(spark, sf_dir):
    return _flow(spark, sf_dir).dim_date


def q_fact_load(spark, sf_dir):
    return _flow(spark, sf_dir).fact


def q_fact_reload_idempotent(spark, sf_dir):
    """The years up to 1995, then a batch that repeats them and adds the rest."""
    st = _flow(spark, sf_dir).staging
    first = new_fact_rows(st.filter(F.col("year") <= 1995), None)
    second = new_fact_rows(st, first)
    return first.withColumn("load", F.lit(1)).unionByName(second.withColumn("load", F.lit(2)))


def q_dim_date_reload(spark, sf_dir):
    return _flow(spark, sf_dir).reloaded.table("dim_date")


def q_dim_region_reload(spark, sf_dir):
    return _flow(spark, sf_dir).reloaded.table("dim_region")


def q_fact_second_batch(spark, sf_dir):
    return _flow(spark, sf_dir).reloaded.table("fact_content_performance")


def q_fact_pruned_load(spark, sf_dir):
    """The same two loads into a fact kept by date, each reading the stored keys it can touch."""
    f = _flow(spark, sf_dir)
    store = FactStore(spark, scratch_path(spark, "fact_store"))
    for batch in f.batches:
        store.load(batch)
    return store.table()


def _bucketed(f: Flow) -> dict[str, DataFrame]:
    """Fact and dim_title as catalog tables in buckets by title."""
    def build() -> dict[str, DataFrame]:
        root = scratch_path(f.spark, "bucketed")
        database = "roi_" + root.rsplit("-", 1)[1]
        f.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
        buckets = max(8, f.tasks)  # a task sorts a bucket, so their number grows with the input
        return {
            "fact": write_bucketed(f.table("fact_content_performance"), f"{database}.fact_content_performance", f"{root}/fact", buckets,
                                   sort_by=["title_id", *FACT_SORT]),
            "dim_title": write_bucketed(f.table("dim_title"), f"{database}.dim_title", f"{root}/dim_title", buckets),
        }

    return f._once("bucketed", build)


FACT_SORT = ["date_id", "region_code"]


def q_mart_bucketed(spark, sf_dir):
    """The mart over bucketed tables: its largest join, by title, needs no exchange."""
    f = _flow(spark, sf_dir)
    tables = _bucketed(f)
    return content_performance_mart(tables["fact"], tables["dim_title"], f.table("dim_region"), f.table("dim_date"))


def q_table_layout(spark, sf_dir):
    """Rows that stand behind a larger one in the files of each stored table: none, by the tables' sort keys."""
    f = _flow(spark, sf_dir)
    tables = _bucketed(f)
    parts = [("fact_content_performance", f.table("fact_content_performance"), ["date_id", "region_code", "title_id"]),
             ("dim_title", f.table("dim_title"), ["title_id"]), ("dim_region", f.table("dim_region"), ["region_code"]),
             ("dim_date", f.table("dim_date"), ["date_id"]), ("fact_bucketed", tables["fact"], ["title_id", *FACT_SORT]),
             ("dim_title_bucketed", tables["dim_title"], ["title_id"])]
    out = None
    for name, table, keys in parts:
        one = order_breaks(table, keys).select(F.lit(name).alias("table_name"), "n_rows", "breaks")
        out = one if out is None else out.unionByName(one)
    return out


def q_catalog_models(spark, sf_dir):
    """Named sources and published views: the warehouse as catalog tables, the licensing model read by its view's name."""
    wh = _flow(spark, sf_dir).warehouse
    named = Warehouse(spark, wh.root, "roi_" + scratch_path(spark, "catalog").rsplit("-", 1)[1])
    named.create()
    publish_views(spark, named.database)
    return spark.table(f"{named.database}.stg_licensing").join(
        named.sources()["dim_title"].select("title_id", "title_name"), "title_id", "left")


# -- models ----------------------------------------------------------------------------------
def q_stg_movies(spark, sf_dir):
    return stg_movies(_flow(spark, sf_dir).table("dim_title"))


def q_stg_user_behavior(spark, sf_dir):
    return stg_user_behavior(_flow(spark, sf_dir).table("fact_content_performance"))


def q_stg_licensing(spark, sf_dir):
    return stg_licensing(_flow(spark, sf_dir).table("fact_content_performance"))


def q_content_performance_mart(spark, sf_dir):
    return _flow(spark, sf_dir).loaded_mart


def q_roi_flag_counts(spark, sf_dir):
    return _flow(spark, sf_dir).loaded_mart.groupBy("roi_flag").agg(F.count(F.lit(1)).alias("n"))


def q_churn_flag(spark, sf_dir):
    return _flow(spark, sf_dir).loaded_mart.select("performance_id", "churn_rate_post_title", "high_churn_risk")


# -- titles -------------------------------------------------------------------------------------
def q_license_grid(spark, sf_dir):
    return license_grid(normalize_titles(b.movies_raw(b.Tables(spark, sf_dir))))


def q_distinct_title_ids(spark, sf_dir):
    return distinct_title_ids(b.licensing_raw(b.Tables(spark, sf_dir)))


def q_title_ids_first_source(spark, sf_dir):
    """Title ids from the first raw source that exists: the licensing CSV is landed, the
    folder looked up before it is absent, so the lookup falls through to licensing."""
    root = scratch_path(spark, "title_sources")
    write_csv(b.licensing_raw(b.Tables(spark, sf_dir)), f"{root}/licensing")
    return title_ids_from_first(spark, [f"{root}/missing", f"{root}/licensing", f"{root}/movies"])


# -- quality --------------------------------------------------------------------------------------
def q_dq_report(spark, sf_dir):
    f = _flow(spark, sf_dir)
    return check_all(f.table("fact_content_performance"), f.table("dim_title"), f.table("dim_region"),
                     f.table("dim_date"))


def q_dq_violations(spark, sf_dir):
    """Every rule on the loaded tables with known faults: values changed by year, rows repeated,
    dimension rows missing, repeated or blank."""
    f = _flow(spark, sf_dir)
    fact, title = f.table("fact_content_performance"), f.table("dim_title")
    year = F.expr("date_id div 10000")
    broken = fact.withColumns({
        "title_id": F.when(year != 1998, F.col("title_id")),
        "cost_per_hour_watched": F.when(year == 1999, F.lit(-1).cast("decimal(18,4)")).otherwise(F.col("cost_per_hour_watched")),
        "sentiment_score": F.when(year == 1995, F.lit(1.5).cast("decimal(6,5)")).otherwise(F.col("sentiment_score")),
        "region_code": F.when(year == 1996, F.lit("XX")).otherwise(F.col("region_code")),
    }).unionByName(fact.filter(year == 1997))
    own = F.col("title_id").cast("long") % 7
    region, date = f.table("dim_region"), f.table("dim_date").filter("year <> 2000")
    return check_all(
        broken,
        title.filter(own != 0).unionByName(title.filter(own == 1)),
        region.unionByName(region.limit(1).select(F.lit(None).cast("string").alias("region_code"), F.lit("nowhere").alias("region_name"))),
        date.withColumns({"quarter": F.when(F.col("year") != 1999, F.col("quarter")),
                          "day_of_week": F.when(F.col("year") != 1995, F.col("day_of_week"))}),
    )


def q_dq_incremental(spark, sf_dir):
    """The report after two loads, from the states that each left."""
    f = _flow(spark, sf_dir)
    store = FactStore(spark, scratch_path(spark, "fact_store"))
    for batch in f.batches:
        store.load(batch)
    return store.check(f.table("dim_title"), f.table("dim_region"), f.table("dim_date"))


def q_curated_upsert(spark, sf_dir):
    """Watch history landed in three parts that overlap, each taken into the curated set by its keys."""
    raw = b.watch_history_raw(b.Tables(spark, sf_dir))
    store = CuratedStore(spark, scratch_path(spark, "curated_watch"), ["session_id"], buckets=16)
    day = F.coalesce(F.dayofmonth("watch_date"), F.lit(0))
    for low, high in ((0, 12), (10, 21), (20, 31)):
        landing = cleaners.clean_watch_history(raw.filter(day.between(low, high)))
        store.upsert(landing)
    return store.table(landing).select(*landing.columns)


def q_dq_duplicates(spark, sf_dir):
    raw = b.watch_history_raw(b.Tables(spark, sf_dir)).withColumnRenamed("Session ID", "session_id")
    return duplicate_keys(raw, "session_id")


def q_dq_referential(spark, sf_dir):
    f = _flow(spark, sf_dir)
    return referential_checks(f.table("fact_content_performance"), f.table("dim_title"),
                              f.table("dim_region"), f.table("dim_date"))


# -- sources, sinks and round trips (write to the shared scratch folder, read back) -----
def q_partition_pruned_read(spark, sf_dir):
    path = scratch_path(spark, "content_performance")
    write_content_performance(_flow(spark, sf_dir).content_performance, path)
    read = spark.read.parquet(path)
    return read.filter((F.col("region_partition") == "AMERICA") & (F.col("year_partition") == 1998))


def q_search_logs_partitioned(spark, sf_dir):
    """Cleaned search logs written partitioned by region and read back through partition
    discovery (the region column comes back from the folder names)."""
    path = scratch_path(spark, "search_logs")
    write_curated(cleaners.clean_search_logs(b.search_logs_raw(b.Tables(spark, sf_dir))), path, ["region"])
    return read_curated(spark, path)


def q_curated_movies_roundtrip(spark, sf_dir):
    """The cleaned catalogue written unpartitioned and read back."""
    path = scratch_path(spark, "movies")
    write_curated(_flow(spark, sf_dir).movies, path)
    return read_curated(spark, path)


def q_normalized_titles_first(spark, sf_dir):
    """The first 50 title ids: the limit is the feature (a preview list)."""
    return normalize_titles(b.movies_raw(b.Tables(spark, sf_dir)), max_titles=50)


def q_raw_csv_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "raw_zone")
    land_raw(b.watch_history_raw(b.Tables(spark, sf_dir)), root, "watch_history", 2024, 3)
    raw = read_raw_zone(spark, root, "watch_history", year=2024, month=3).drop("year", "month")
    return cleaners.clean_watch_history(raw)


def q_multiline_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "reviews_csv")
    write_csv(b.reviews_raw(b.Tables(spark, sf_dir)), path)
    return cleaners.clean_review_sentiment(read_raw_csv(spark, path, multiline=True))


def q_play_events_usage(spark, sf_dir):
    events = b.play_events_raw(b.Tables(spark, sf_dir))
    return usage_by_title_region_year(prepare_usage(events_to_watch(events)))


def q_play_events_batch(spark, sf_dir):
    """Usage from play events landed as JSON Lines and read back in batch."""
    root = _landed_events(spark, sf_dir)
    return usage_by_title_region_year(prepare_usage(events_to_watch(read_play_events(spark, root))))


def _landed_events(spark, sf_dir) -> str:
    root = scratch_path(spark, "play_events")
    land_play_events(b.play_events_raw(b.Tables(spark, sf_dir)), root)
    return root


def q_stream_daily_usage(spark, sf_dir):
    source = _landed_events(spark, sf_dir)
    out = scratch_path(spark, "daily_usage")
    query = start_daily_usage_stream(spark, source, out, scratch_path(spark, "daily_usage_ckpt"),
                                     watermark="400 days", approx_viewers=False)
    query.awaitTermination()
    if dropped := rows_dropped(query):
        raise RuntimeError(f"{dropped} rows fell behind the watermark; choose one that spans the backlog")
    return read_latest(spark, out, ["window_start", "window_end", "title_id", "region"])


def q_stream_usage_refresh(spark, sf_dir):
    source = _landed_events(spark, sf_dir)
    out = scratch_path(spark, "usage_refresh")
    query = start_usage_refresh(spark, source, scratch_path(spark, "usage_landing"), out,
                                scratch_path(spark, "usage_refresh_ckpt"))
    query.awaitTermination()
    return read_latest(spark, out, ["title_id", "region", "year"])


def q_viewers_rollup(spark, sf_dir):
    """Viewers by title and month from landed daily sketches, held against the exact count."""
    plays = window_plays(b.play_events_raw(b.Tables(spark, sf_dir)))
    months = roll_up(stored(viewer_sketches(plays), "viewer-sketches"))
    exact = plays.groupBy("title_id", F.trunc(F.to_date("timestamp"), "month").alias("month")).agg(F.count_distinct("user_id").alias("exact"))
    return months.join(exact, ["title_id", "month"]).select(
        "title_id", "month", "plays", F.col("exact").alias("viewers"),
        (F.abs(F.col("viewers") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * ERROR)).alias("estimate_within_bound"))


def _streamed_windows(spark, sf_dir, times: int, late: bool):
    """Windows from events landed ``times`` times; with ``late`` the days come newest first, each in its own run."""
    root = scratch_path(spark, "play_events")
    events = b.play_events_raw(b.Tables(spark, sf_dir))
    out, landing, ckpt = (scratch_path(spark, n) for n in ("windows", "windows_landing", "windows_ckpt"))
    middle = events.agg(F.expr("percentile_approx(unix_timestamp(cast(timestamp as timestamp)), 0.5)")).first()[0]
    newer = F.unix_timestamp(F.col("timestamp").cast("timestamp")) >= F.lit(middle)
    batches = [events.filter(newer), events.filter(F.coalesce(~newer, F.lit(True)))] if late else [events] * times
    for batch in batches:
        land_play_events(batch, root)
        start_windowed_usage(spark, root, landing, out, ckpt, watermark="1 day", redelivered=times > 1).awaitTermination()
    return read_latest(spark, out, ["window_start", "window_end", "title_id", "region"])


def q_stream_late_rows(spark, sf_dir):
    """The older half of the events arrives after the newer one: nothing is lost, and what was late is counted."""
    found = _streamed_windows(spark, sf_dir, 1, True)
    return found.select("window_start", "window_end", "title_id", "region", "watch_minutes", "plays")


def q_stream_redelivered(spark, sf_dir):
    """All events delivered twice count once."""
    found = _streamed_windows(spark, sf_dir, 2, False)
    return found.select("window_start", "window_end", "title_id", "region", "watch_minutes", "plays")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_licensing": q_clean_licensing,
    "clean_movies": q_clean_movies,
    "clean_users": q_clean_users,
    "clean_watch_history": q_clean_watch_history,
    "clean_recommendation_logs": q_clean_recommendation_logs,
    "clean_search_logs": q_clean_search_logs,
    "review_sentiment": q_review_sentiment,
    "normalize_region": q_normalize_region,
    "content_type_map": q_content_type_map,
    "usage_by_title_region_year": q_usage_by_title_region_year,
    "usage_fractional_minutes": q_usage_fractional_minutes,
    "license_pick": q_license_pick,
    "license_pick_spread": q_license_pick_spread,
    "usage_licensed_only": q_usage_licensed_only,
    "content_performance_core": q_content_performance_core,
    "content_performance": q_content_performance,
    "output_conformance": q_output_conformance,
    "licence_gate": q_licence_gate,
    "staging_load": q_staging_load,
    "dim_title_rollup": q_dim_title_rollup,
    "dim_title_insert_if_absent": q_dim_title_insert_if_absent,
    "dim_region_load": q_dim_region_load,
    "dim_date_load": q_dim_date_load,
    "fact_load": q_fact_load,
    "fact_reload_idempotent": q_fact_reload_idempotent,
    "dim_date_reload": q_dim_date_reload,
    "dim_region_reload": q_dim_region_reload,
    "fact_second_batch": q_fact_second_batch,
    "fact_pruned_load": q_fact_pruned_load,
    "mart_bucketed": q_mart_bucketed,
    "table_layout": q_table_layout,
    "catalog_models": q_catalog_models,
    "stg_movies": q_stg_movies,
    "stg_user_behavior": q_stg_user_behavior,
    "stg_licensing": q_stg_licensing,
    "content_performance_mart": q_content_performance_mart,
    "roi_flag_counts": q_roi_flag_counts,
    "churn_flag": q_churn_flag,
    "license_grid": q_license_grid,
    "distinct_title_ids": q_distinct_title_ids,
    "title_ids_first_source": q_title_ids_first_source,
    "partition_pruned_read": q_partition_pruned_read,
    "dq_report": q_dq_report,
    "dq_violations": q_dq_violations,
    "curated_movies_roundtrip": q_curated_movies_roundtrip,
    "normalized_titles_first": q_normalized_titles_first,
    "dq_incremental": q_dq_incremental,
    "curated_upsert": q_curated_upsert,
    "dq_duplicates": q_dq_duplicates,
    "dq_referential": q_dq_referential,
    "play_events_usage": q_play_events_usage,
    "play_events_batch": q_play_events_batch,
    "search_logs_partitioned": q_search_logs_partitioned,
    "raw_csv_roundtrip": q_raw_csv_roundtrip,
    "multiline_csv_roundtrip": q_multiline_csv_roundtrip,
    "stream_daily_usage": q_stream_daily_usage,
    "stream_usage_refresh": q_stream_usage_refresh,
    "stream_late_rows": q_stream_late_rows,
    "stream_redelivered": q_stream_redelivered,
    "viewers_rollup": q_viewers_rollup,
}
