"""Driver tables -> raw-shaped datasets.

The test tables are a TPC-H-like star schema plus events, documents and conversations. These
bindings map them, independent of scale factor, onto the raw column names the cleaners expect,
so every query's work grows with the given tables. They are test inputs, not library
semantics; the DuckDB oracle re-states each of them in SQL. Every row of a table is bound; some
values are bound blank, null or out of range by key, so that the cleaners' filters, the fallback
branches of the licence pick and all flags have rows to act on.

| raw dataset          | from                                         |
|----------------------|----------------------------------------------|
| watch_history        | lineitem, orders, customer, nation, region   |
| movies               | part                                         |
| licensing_costs      | lineitem, supplier, nation, region           |
| users                | customer, nation, first order date           |
| reviews              | documents, labels                            |
| recommendation_logs  | events                                       |
| search_logs          | conversations, region                        |
| play events          | events                                       |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_stamps

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values for the play-event binding (regions and devices of the event record).
EVENT_REGIONS = ("US", "CA", "GB", "IN", "BR", "MX", "DE", "JP")
EVENT_DEVICES = ("TV", "Mobile", "Tablet", "Web", "Game Console")


#: Suppliers whose files are no larger are sent to every task, in place of dealing all order lines by their supplier.
SENT_SUPPLIERS = 12 << 20


class Tables:
    """Lazy access to the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def _geo(t: Tables) -> DataFrame:
    """nation + region names, few rows that meet many."""
    return F.broadcast(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    ))


def _suppliers(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_nationkey")
    size = sum(length for _, length, _ in file_stamps(t.spark, f"{t.sf_dir}/supplier.parquet"))
    return F.broadcast(s) if size <= SENT_SUPPLIERS else s


def watch_history_raw(t: Tables) -> DataFrame:
    """One session per order line. Orders divisible by 13 have no date; the region is null, blank or a
    spelling to normalise for some remainders by 11."""
    li = t.lineitem
    order = F.col("l_orderkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey")
    # orders meet their customers first, so that order lines, the most rows, move once
    placed = o.join(c, o.o_custkey == c.c_custkey).join(_geo(t), F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        li.join(placed, li.l_orderkey == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("Session ID"),
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("l_partkey").alias("movie_id"),
            F.when(order % 13 != 0, F.col("l_shipdate")).alias("watch_date"),
            F.col("o_orderpriority").alias("device_type"),
            (F.col("l_quantity") * 600).alias("watch_duration_minutes"),
            (F.col("l_discount") * 1000.0).alias("progress_percentage"),
            F.col("l_returnflag").alias("action"),
            F.col("l_linestatus").alias("quality"),
            F.when(order % 11 == 0, F.lit(None)).when(order % 11 == 1, F.lit("")).when(order % 11 == 2, F.lit("usa "))
            .when(order % 11 == 3, F.lit("Germany")).otherwise(F.col("r_name")).alias("location_country"),
            F.when(F.col("l_tax") >= 0.04, F.lit("yes")).otherwise(F.lit("no")).alias("is_download"),
            (F.col("l_tax") * 100.0).alias("user_rating"),
        )
    )


def fractional_watch(t: Tables) -> DataFrame:
    """One session per order line whose minutes have fractions of 2^-20, many far below a hundredth: their sums
    fit a double exactly, so that any engine's sum of doubles can be held against them."""
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey")
    part = F.col("l_partkey")
    whole = F.when(part % 4 == 0, F.lit(0)).otherwise(F.col("l_quantity"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("title_id"),
        F.col("l_returnflag").alias("region"), F.col("l_shipdate").alias("watch_date"),
        (whole + (F.col("l_orderkey") * 37 + F.col("l_linenumber")) % 4001 / F.lit(float(1 << 20))).alias("watch_duration_mins"))


def movies_raw(t: Tables) -> DataFrame:
    p = t.part
    size_mod = F.col("p_size") % 5
    return p.select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre_primary"),
        F.col("p_brand").alias("genre_secondary"),
        (F.lit(1980) + (F.col("p_partkey") % 40)).cast("int").alias("release_year"),
        F.when(size_mod == 0, F.lit("TV")).when(size_mod == 1, F.lit("Series")).otherwise(F.lit("film")).alias("Media_Type "),
        F.col("p_retailprice").alias("popularity"),
        F.col("p_size").alias("duration_minutes"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("Yes"))
        .when(F.col("p_partkey") % 3 == 1, F.lit("no"))
        .alias("is_netflix_original"),
    )


def licensing_raw(t: Tables) -> DataFrame:
    """Per (part, supplier region, ship year): a fifth of the summed price, in whole dollars.

    Years outside 1997-1999 are bound as null (undated licences), as is every year of parts ending
    in 8. Parts ending in 0 have no cost and parts ending in 9 a negative one in odd years: the
    cleaner drops those rows."""
    li = t.lineitem
    s = _suppliers(t)
    base = (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .join(_geo(t), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("l_partkey").alias("title_id"), F.col("r_name").alias("region"), F.year("l_shipdate").alias("ship_year"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"))
    )
    usd = F.expr("cast(price * 100 as bigint) div 500")
    last = F.col("title_id") % 10
    return base.select(
        "title_id",
        F.when(last == 0, F.lit(None)).when((last == 9) & (F.col("ship_year") % 2 == 1), -usd - 1_000_000)
        .otherwise(usd).alias("license_cost_usd"),
        F.when(F.col("ship_year").between(1997, 1999) & (last != 8), F.col("ship_year")).cast("int").alias("license_year"),
        "region",
    )


def users_raw(t: Tables) -> DataFrame:
    first_order = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    c = t.customer
    return (
        c.join(t.nation, c.c_nationkey == F.col("n_nationkey"))
        .join(first_order, c.c_custkey == first_order.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.concat(F.col("c_name"), F.lit("@Example.COM")).alias("email"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("subscription_plan"),
            F.col("first_order").alias("subscription_start_date"),
            F.col("c_acctbal").alias("monthly_spend"),
        )
    )


def reviews_raw(t: Tables) -> DataFrame:
    """Every document as a review of one of n / 3 titles; unlabelled ones have no sentiment and some
    labelled ones a score out of range."""
    d = t.documents.select("doc_id", "text")
    return d.join(t.labels, "doc_id", "left").select(
        F.expr("doc_id div 3 + 1").alias("movie_id"),
        F.when(F.col("quality").isNull(), F.lit(None))
        .when(F.col("doc_id") % 50 == 7, F.lit("1.5"))
        .when(F.col("toxic") == 1, F.lit("0.5"))
        .when(F.col("quality") == 1, F.lit("positive"))
        .otherwise(F.lit("negative"))
        .alias("sentiment"),
        F.col("text").alias("review"),
    )


def recommendation_logs_raw(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("recommendation_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").alias("movie_id"),
        F.col("ts").alias("recommendation_date"),
        F.col("event_type").alias("recommendation_type"),
        (F.col("value") / 100.0).alias("recommendation_score"),
        (F.col("event_type") == "click").alias("was_clicked"),
        ((F.col("user_id") % 10) + 1).alias("position_in_list"),
    )


def search_logs_raw(t: Tables) -> DataFrame:
    conv = t.conversations
    return conv.join(t.region, (conv.conv_id % 5) == F.col("r_regionkey")).select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("search_id"),
        F.col("conv_id").cast("string").alias("user_id"),
        F.col("text").alias("search_query"),
        F.concat(F.lit("2024-02-"), F.lpad(((F.col("turn") % 28) + 1).cast("string"), 2, "0"), F.lit(" 10:00:00")).alias("search_date"),
        F.col("turn").alias("results_returned"),
        F.col("r_name").alias("location_country"),
    )


def play_events_raw(t: Tables) -> DataFrame:
    """Events in the play-event record shape (seven fields); views become 'play'."""
    e = t.events
    regions = F.array(*[F.lit(r) for r in EVENT_REGIONS])
    devices = F.array(*[F.lit(d) for d in EVENT_DEVICES])
    return e.select(
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user_id"),
        F.get_json_object("props", "$.k").alias("title_id"),
        F.when(F.col("event_type") == "view", F.lit("play")).otherwise(F.col("event_type")).alias("event"),
        F.ceil("value").cast("int").alias("watch_duration_mins"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.element_at(regions, (F.col("user_id") % len(EVENT_REGIONS) + 1).cast("int")).alias("region"),
        F.element_at(devices, (F.col("event_id") % len(EVENT_DEVICES) + 1).cast("int")).alias("device"),
    )


def churn_input(curated_watch: DataFrame, no_year: int | None = None) -> DataFrame:
    """Stand-in churn input per (title_id, region, year) for the mart's churn flag: the share
    of sessions whose action is 'R'. The pipeline itself computes no churn; this is supplied
    test input, keyed like the usage groups. ``no_year`` stands for a null year, if given."""
    from ..functions.domain import normalize_region

    year = F.year("watch_date")
    return curated_watch.groupBy(
        F.col("title_id"),
        normalize_region(F.col("region")).alias("region"),
        (year if no_year is None else F.coalesce(year, F.lit(no_year))).alias("year"),
    ).agg(F.avg(F.when(F.col("action") == "R", 1.0).otherwise(0.0)).alias("churn_rate_post_title"))
