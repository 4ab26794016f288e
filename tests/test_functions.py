import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from screenroi.functions import domain as d
from screenroi.functions.casts import cast_column, optional
from screenroi.functions.names import (
    ColumnCollisionError, MissingColumnsError, require_columns, resolve_columns, snake_case, snake_case_columns,
)


@pytest.mark.parametrize("raw,expected", [
    (" Movie-ID ", "movie_id"), ("Watch Duration (Minutes)", "watch_duration_minutes"),
    ("__a__b__", "a_b"), ("userID", "userid"), ("Location  Country", "location_country"),
])
def test_snake_case(raw, expected):
    assert snake_case(raw) == expected


def test_snake_case_columns_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Movie ID` int, `movie-id` int")
    with pytest.raises(ColumnCollisionError):
        snake_case_columns(df)


def test_resolve_columns(spark):
    ids = {"id": ("title_id", "movie_id")}
    assert resolve_columns(["Title", "movie_id"], ids) == {"id": "movie_id"}
    assert resolve_columns(["TITLE_ID", "movie_id"], ids) == {"id": "TITLE_ID"}
    assert resolve_columns([" id "], {"id": ("id",)}, strip=True) == {"id": " id "}
    assert resolve_columns(["Id", "ID"], {"id": ("id",)}) == {"id": "Id"}
    assert resolve_columns(["x"], ids) == {"id": None}
    with pytest.raises(MissingColumnsError, match=r"The list has no column for id \(one of title_id, movie_id\)"):
        resolve_columns(["x"], ids, ("id",), "list")
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(MissingColumnsError, match=r"b \(one of b\); c \(one of c\)\. It has \['a'\]"):
        require_columns(df, {"c", "b", "a"}, "t")


def test_lenient_casts_from_text(spark):
    vals = ["abc", "3.5", "NaN", "-1", " 7 ", "1.0", None, "yes", "0"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = df.select(
        "s",
        cast_column(df, "s", "int").alias("i"),
        cast_column(df, "s", "double").alias("d"),
        cast_column(df, "s", "boolean").alias("b"),
    ).collect()
    got = {r.s: (r.i, r.d, r.b) for r in out}
    assert got["abc"] == (None, None, None)
    assert got["3.5"][0] == 3 and got["3.5"][1] == 3.5 and got["3.5"][2] is True
    assert got["NaN"][0] is None and math.isnan(got["NaN"][1])
    assert got["-1"] == (-1, -1.0, True)
    assert got[" 7 "][0] == 7
    assert got["1.0"] == (1, 1.0, True)
    assert got["yes"] == (None, None, True)
    assert got["0"] == (0, 0.0, False)
    assert got[None] == (None, None, None)


def test_lenient_dates(spark):
    vals = ["2024-3-1", "03/01/2024", "2024-02-30", "2024-01-05T10:11:12", "garbage"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = {r.s: (r.d, r.t) for r in df.select(
        "s", cast_column(df, "s", "date").alias("d"), cast_column(df, "s", "timestamp").alias("t")).collect()}
    assert got["2024-3-1"][0] == dt.date(2024, 3, 1)
    assert got["03/01/2024"] == (None, None)
    assert got["2024-02-30"] == (None, None)
    assert got["2024-01-05T10:11:12"][0] == dt.date(2024, 1, 5)
    assert got["garbage"] == (None, None)


def test_optional_missing_is_typed_null(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = df.select(optional(df, "nope", "date").alias("x"), optional(df, None, "int").alias("y"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["date", "int"]
    assert out.first() == (None, None)


def test_content_type_and_truthy(spark):
    df = spark.createDataFrame([(v,) for v in ["TV", "Series", " tv show ", "miniseries", "film", None]], "t string")
    out = {r.t: (r.narrow, r.wide, r.orig) for r in df.select(
        "t", d.content_type(F.col("t")).alias("narrow"),
        d.content_type(F.col("t"), d.SERIES_WORDS_WIDE, trim=True).alias("wide"),
        d.truthy(F.col("t")).alias("orig")).collect()}
    assert out["TV"] == ("series", "series", False)
    assert out["Series"][0] == "series"
    assert out[" tv show "] == ("movie", "series", False)
    assert out["miniseries"] == ("movie", "series", False)
    assert out["film"] == ("movie", "movie", False)
    assert out[None] == ("movie", "movie", False)
    t = spark.createDataFrame([(v,) for v in ["TRUE", "1", "Yes", "no", None]], "t string")
    assert [r.x for r in t.select(d.truthy(F.col("t")).alias("x")).collect()] == [True, True, True, False, False]


def test_sentiment_values(spark):
    vals = ["POS", "neg", "1", "0.4", "7", "meh", "true", "Negative"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = {r.s: r.v for r in df.select("s", d.sentiment_value(F.col("s")).alias("v")).collect()}
    assert got == {"POS": 1.0, "neg": 0.0, "1": 1.0, "0.4": 0.4, "7": 7.0, "meh": None, "true": 1.0, "Negative": 0.0}


def test_normalize_region(spark):
    vals = [" usa ", "United Kingdom", "gb", "", None, "united states of america", "Japan", "Mars"]
    df = spark.createDataFrame([(v,) for v in vals], "r string")
    got = [r.n for r in df.select(d.normalize_region(F.col("r")).alias("n")).collect()]
    assert got == ["US", "UK", "GB", "", "UNKNOWN", "US", "JP", "MARS"]
    b = spark.createDataFrame([(v,) for v in ["", None, "US"]], "r string")
    assert [r.n for r in b.select(d.blank_to_unknown(F.col("r")).alias("n")).collect()] == ["UNKNOWN", "UNKNOWN", "US"]


def test_flags_and_ratio(spark):
    df = spark.createDataFrame([(v,) for v in [19.99, 20.0, 50.0, 50.01, None]], "c double")
    assert [r.f for r in df.select(d.roi_flag(F.col("c")).alias("f")).collect()] == [
        "high ROI", "medium ROI", "medium ROI", "low ROI", "high ROI"]
    ch = spark.createDataFrame([(v,) for v in [0.3, 0.31, None]], "c double")
    assert [r.f for r in ch.select(d.churn_flag(F.col("c")).alias("f")).collect()] == [False, True, False]
    r = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (10.0, None)], "c double, h double")
    assert [x.v for x in r.select(d.guarded_ratio(F.col("c"), F.col("h")).alias("v")).collect()] == [None, 2.5, None]


def test_performance_key(spark):
    import hashlib

    df = spark.createDataFrame([("t1", "US", 2024), ("t1", "US", None)], "t string, r string, y int")
    got = [r.k for r in df.select(d.performance_key(F.col("t"), F.col("r"), F.col("y")).alias("k")).collect()]
    assert got[0] == hashlib.sha256(b"t1|US|2024").hexdigest()
    assert got[1] == hashlib.sha256(b"t1|US").hexdigest()
