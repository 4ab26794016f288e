"""Exact sums of doubles: those of math.fsum, in any order and partitioning."""

import math
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from screenroi.functions.exact import exact_part, exact_total


def sums(spark, groups, partitions=5, merges=True):
    rows = [(k, v) for k, values in enumerate(groups) for v in values]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double").repartition(partitions).select("k", exact_part(F.col("v")).alias("p"))
    parts = df.filter("p is not null").groupBy("k", "p.band").agg(F.sum("p.part").alias("part"))
    totals = parts.groupBy("k").agg(F.collect_list(F.struct("band", "part")).alias("bands")).select("k", exact_total("bands").alias("s"))
    return {r.k: r.s for r in totals.collect()}


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == b


def wanted(values):
    try:
        return math.fsum(values)
    except OverflowError:
        return math.inf if sum(v / 2 ** 60 for v in values) > 0 else -math.inf
    except ValueError:  # both infinities
        return math.nan


def check(spark, groups):
    found = sums(spark, groups)
    for k, values in enumerate(groups):
        if values:
            assert same(found[k], wanted(values)), (values, found[k], wanted(values))


def test_random_bit_patterns(spark):
    rng = random.Random(7)
    def any_double():
        while True:
            v = struct.unpack("d", rng.randbytes(8))[0]
            if math.isfinite(v):
                return v
    groups = [[any_double() for _ in range(rng.randint(1, 12))] for _ in range(150)]
    groups += [[rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(rng.randint(1, 60))] for _ in range(150)]
    groups += [[rng.uniform(0, 300) for _ in range(200)] for _ in range(50)]  # minutes
    check(spark, groups)


def test_cancellation_ties_and_ends(spark):
    tiny, big = 5e-324, 1.7976931348623157e308
    check(spark, [
        [1e300, 1e-5, -1e300], [1e16, 1.0, 1e-300], [1.0, 2.0 ** -53], [1.0, 2.0 ** -53, 2.0 ** -200], [1.0, 2.0 ** -53, -(2.0 ** -200)],
        [1.0 + 2.0 ** -52, 2.0 ** -53], [tiny], [tiny, tiny, tiny], [tiny, -tiny], [2.2250738585072014e-308, -tiny], [big, -big, 1.0], [big], [-big, tiny],
        [big, 1e292], [big, big], [-big, -big], [0.0, -0.0], [0.0], [0.1] * 10, [-0.1] * 10, [1e-320, 3e-310, -1e-315], [2.0 ** 53, 1.0, 1.0], [2.0 ** 53, 1.0],
        [2.0 ** k for k in range(-60, 60)], [-(2.0 ** k) for k in range(-1074, 1023, 7)], [2.0 ** k * (-1) ** k for k in range(-1074, 1023)], [0.004] * 1000,
    ])


def test_not_finite(spark):
    nan, inf = math.nan, math.inf
    check(spark, [[nan, 60.0], [inf, 1.0], [-inf, 1e308], [inf, -inf], [inf, inf], [nan, inf], [1e17, 3.0]])


def test_nulls_add_nothing(spark):
    assert sums(spark, [[None, 1.5, None], [None]]) == {0: 1.5}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=8), min_size=1, max_size=30))
def test_any_doubles(spark, groups):
    check(spark, groups)


def test_any_partitioning_gives_the_same_bits(spark):
    rng = random.Random(3)
    groups = [[rng.uniform(-1e9, 1e9) ** 3 for _ in range(500)]]
    assert len({sums(spark, groups, n)[0] for n in (1, 2, 7)}) == 1


def test_hot_group_is_summed_before_the_shuffle(spark):
    df = spark.range(1000).select(exact_part(F.col("id") / 7.0).alias("p")).groupBy("p.band").agg(F.sum("p.part").alias("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
