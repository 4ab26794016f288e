"""Correctness gate: every registered query equals its DuckDB SQL twin (sf0.001)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from screenroi.plans.catalog import QUERIES  # noqa: E402
from screenroi.plans.oracle import oracle_sql  # noqa: E402
from compare_oracle import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_contract():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 24


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert "error" not in res, res.get("error")
    assert res["spark_rows"] == res["oracle_rows"]
    assert res["cols_match"], res.get("cols")
    assert res["exact"], res
