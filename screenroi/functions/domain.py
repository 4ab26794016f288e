"""Domain scalar functions, all Column -> Column and JVM-side (no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the pipeline contract for results to match.
# ---------------------------------------------------------------------------
# Content-type words that mean "series" (cleaned catalogue).
SERIES_WORDS = ("tv", "show", "series", "tv_series")
# Wider set used when building the licence grid from a title list.
SERIES_WORDS_WIDE = ("tv", "show", "series", "tv_series", "tv show", "miniseries")
# Text values read as true for the "original" flag.
TRUTHY_WORDS = ("true", "1", "yes")
# Sentiment labels.
POSITIVE_WORDS = ("positive", "pos", "1", "true")
NEGATIVE_WORDS = ("negative", "neg", "0", "false")
# Country spellings -> region codes (input is trimmed and upper-cased first).
REGION_SPELLINGS = {
    "USA": "US",
    "UNITED STATES": "US",
    "UNITED STATES OF AMERICA": "US",
    "CANADA": "CA",
    "UNITED KINGDOM": "UK",
    "INDIA": "IN",
    "BRAZIL": "BR",
    "MEXICO": "MX",
    "GERMANY": "DE",
    "JAPAN": "JP",
}
UNKNOWN_REGION = "UNKNOWN"
# Mart thresholds: cost per hour watched (USD) and churn rate.
ROI_LOW_ABOVE = 50
ROI_MEDIUM_FROM = 20
CHURN_HIGH_ABOVE = 0.3
# ---------------------------------------------------------------------------


def content_type(col: Column, series_words: Iterable[str] = SERIES_WORDS, trim: bool = False) -> Column:
    """'series' when the lower-cased (optionally trimmed) text is a series word, else
    'movie' (null included)."""
    text = F.lower(col.cast("string"))
    if trim:
        text = F.trim(text)
    return F.when(text.isin(*series_words), F.lit("series")).otherwise(F.lit("movie"))


def truthy(col: Column, words: Iterable[str] = TRUTHY_WORDS) -> Column:
    """True when lower(text) is one of ``words``; false otherwise, null included."""
    return F.when(F.lower(col.cast("string")).isin(*words), F.lit(True)).otherwise(F.lit(False))


def sentiment_value(col: Column) -> Column:
    """Label words map to 1.0 / 0.0; anything else is read as a number (bad text -> null)."""
    text = F.lower(col.cast("string"))
    return (
        F.when(text.isin(*POSITIVE_WORDS), F.lit(1.0))
        .when(text.isin(*NEGATIVE_WORDS), F.lit(0.0))
        .otherwise(col.cast("string").try_cast("double"))
    )


def normalize_region(col: Column, spellings: Mapping[str, str] = REGION_SPELLINGS) -> Column:
    """Trim + upper; known country spellings become codes; other text stays upper-cased;
    null becomes UNKNOWN (a blank string stays blank)."""
    text = F.upper(F.trim(col.cast("string")))
    by_code: dict[str, list[str]] = {}
    for spelling, code in spellings.items():
        by_code.setdefault(code, []).append(spelling)
    out = F
    for code, names in by_code.items():
        out = out.when(text.isin(*names), F.lit(code))
    return out.otherwise(F.coalesce(text, F.lit(UNKNOWN_REGION)))


def blank_to_unknown(col: Column) -> Column:
    """Null or '' -> 'UNKNOWN' (warehouse region code)."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(UNKNOWN_REGION))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator only when denominator > 0, else null."""
    return F.when(denominator > 0, numerator / denominator)


def performance_key(title_id: Column, region: Column, year: Column) -> Column:
    """SHA-256 hex of 'title|region|year' (null parts are skipped by concat_ws)."""
    return F.sha2(F.concat_ws("|", title_id, region, year.cast("string")), 256)


def date_key(year: Column) -> Column:
    """First-of-January date id, yyyymmdd as int."""
    return year * 10000 + 101


def roi_flag(cost_per_hour: Column) -> Column:
    """'low ROI' above 50, 'medium ROI' from 20 to 50, 'high ROI' otherwise (null too)."""
    return (
        F.when(cost_per_hour > ROI_LOW_ABOVE, F.lit("low ROI"))
        .when(cost_per_hour.between(ROI_MEDIUM_FROM, ROI_LOW_ABOVE), F.lit("medium ROI"))
        .otherwise(F.lit("high ROI"))
    )


def churn_flag(churn_rate: Column) -> Column:
    """True above 0.3; false otherwise (null too)."""
    return F.coalesce(churn_rate > CHURN_HIGH_ABOVE, F.lit(False))


def non_blank(col: Column) -> Column:
    """Not null and not empty after trimming."""
    return col.isNotNull() & (F.length(F.trim(col)) > 0)
