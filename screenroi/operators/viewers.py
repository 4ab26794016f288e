"""Distinct viewers from mergeable sketches.

Counts of distinct viewers do not add up over days or regions; their HyperLogLog sketches do. A day's sketches are
landed once, and any longer period or wider group is a union of those, without the plays. With ``lg_k`` = 12 a
sketch is at most some 4 KB and an estimate's standard error 1.04 / sqrt(4096), 1.6 %; ``ERROR`` is three of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
ERROR = 0.05


def viewer_sketches(plays: DataFrame, by: Sequence[str] = ("title_id", "region"), lg_k: int = LG_K) -> DataFrame:
    """(by, day, plays, viewers sketch) of plays with user_id and timestamp; plays without a time have a null day."""
    day = F.to_date("timestamp").alias("day")
    return plays.groupBy(*by, day).agg(F.count(F.lit(1)).alias("plays"), F.hll_sketch_agg("user_id", lg_k).alias("viewers"))


def roll_up(sketches: DataFrame, by: Sequence[str] = ("title_id",), period: str = "month") -> DataFrame:
    """(by, period, plays, viewers estimate) from sketches alone, by union."""
    start = F.trunc("day", period).alias(period)
    return sketches.groupBy(*by, start).agg(
        F.sum("plays").alias("plays"), F.hll_sketch_estimate(F.hll_union_agg("viewers")).alias("viewers"))
