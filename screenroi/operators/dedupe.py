"""Deterministic keep-one-row-per-key dedupe.

``dropDuplicates`` keeps an arbitrary row, which differs run to run. Here the kept row is the
smallest under all remaining columns (in the given order, ascending, nulls last), so the
result is a function of the input *set*, not of file order or partitioning.

Plan: ``row_number() = 1`` over the key. Spark plans it as a **partial** ``WindowGroupLimit``
before the shuffle (each map task keeps only its best row per key, so a hot key holding a
third of all rows is reduced to one row per task before it moves), then the exchange on the
key, then the final ``WindowGroupLimit``. Sorts are code-generated; no aggregation buffer of
wide structs is compared row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (default: every non-key column in
    schema order), each ascending with nulls last; columns not named in ``order`` break any
    remaining tie in schema order. Column order of ``df`` is kept."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    tail = [c for c in rest if c not in order]
    by = [F.col(c).asc_nulls_last() for c in order + tail]
    w = Window.partitionBy(*keys).orderBy(*by) if by else Window.partitionBy(*keys).orderBy(F.lit(0))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
