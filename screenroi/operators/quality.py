"""Data-quality rules over the fact table and the star schema.

Output contract: DataFrame(rule string, violations long, passed boolean). The fact is read once:
its keys are looked up in the dimensions by left joins, rows are summed per performance_id, and one
aggregate of that gives every rule. Each dimension is read once more, summed per key. Which columns
may not be null comes from the table contracts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .warehouse import DIM_DATE_SCHEMA, DIM_REGION_SCHEMA, DIM_TITLE_SCHEMA, FACT_SCHEMA

MIN_FACT_ROWS = 1000
DIMENSIONS = {"dim_title": ("title_id", DIM_TITLE_SCHEMA), "dim_region": ("region_code", DIM_REGION_SCHEMA),
              "dim_date": ("date_id", DIM_DATE_SCHEMA)}


def _rows(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One-row aggregate -> (rule, violations, passed) rows via stack."""
    stack = "stack({n}, {args}) as (rule, violations)".format(
        n=len(pairs), args=", ".join(f"'{rule}', cast({col} as bigint)" for rule, col in pairs)
    )
    return df.selectExpr(stack).withColumn("passed", F.col("violations") == 0)


def _required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def _per_key(df: DataFrame, key: str, faults: dict[str, Column]) -> DataFrame:
    """One row: the sum of each fault over all rows, ``__rows``, and ``__dups``, the keys with several rows."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(c).alias(n) for n, c in faults.items()])
    return per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__rows"), F.count_if(F.col("__n") > 1).alias("__dups"),
                       *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in faults])


def _row_faults() -> dict[str, Column]:
    """DQ1, DQ2, DQ3 and the other not-null columns of the fact."""
    faults = {f"fact_{c}_not_null": F.col(c).isNull() for c in _required(FACT_SCHEMA)}
    faults["cost_per_hour_not_negative"] = F.col("cost_per_hour_watched") < 0
    faults["sentiment_between_0_and_1"] = ~F.col("sentiment_score").between(0, 1)
    return faults


def _with_parents(fact: DataFrame, dims: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, Column]]:
    """``fact`` with a mark for each dimension that has its key, and the faults of DQ7 (a null key has no
    parent). Keys are made distinct first, so a duplicated dimension row multiplies nothing."""
    faults = {}
    for name, dim in dims.items():
        key = DIMENSIONS[name][0]
        parent = dim.select(F.col(key).alias(f"__{name}")).distinct()
        fact = fact.join(parent, fact[key] == parent[f"__{name}"], "left")
        faults[f"fact_{name.removeprefix('dim_')}_in_{name}"] = F.col(f"__{name}").isNull()
    return fact, faults


def fact_checks(fact: DataFrame, min_rows: int = MIN_FACT_ROWS, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """DQ1-DQ5 of the fact and, with ``dims``, DQ7: one scan of the fact."""
    joined, orphans = _with_parents(fact, dims or {})
    faults = _row_faults() | orphans
    found = _per_key(joined, "performance_id", faults).withColumn(
        "__short", F.greatest(F.lit(min_rows + 1) - F.col("__rows"), F.lit(0)))
    return _rows(found, [(n, n) for n in faults] + [
        (f"fact_row_count_above_{min_rows}", "__short"), ("performance_id_unique", "__dups")])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts (HAVING count(*) > 1)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def referential_checks(fact: DataFrame, dim_title: DataFrame, dim_region: DataFrame,
                       dim_date: DataFrame) -> DataFrame:
    """DQ7: every fact key has its dimension row."""
    joined, faults = _with_parents(fact, {"dim_title": dim_title, "dim_region": dim_region, "dim_date": dim_date})
    return _rows(joined.agg(*[F.count_if(c).alias(n) for n, c in faults.items()]), [(n, n) for n in faults])


def dimension_checks(name: str, dim: DataFrame) -> DataFrame:
    """DQ8: the key is unique and every column the contract calls not null is filled."""
    key, schema = DIMENSIONS[name]
    faults = {f"{name}_{c}_not_null": F.col(c).isNull() for c in _required(schema)}
    return _rows(_per_key(dim, key, faults), [(n, n) for n in faults] + [(f"{name}_{key}_unique", "__dups")])


def check_all(fact: DataFrame, dim_title: DataFrame | None = None, dim_region: DataFrame | None = None,
              dim_date: DataFrame | None = None, min_rows: int = MIN_FACT_ROWS) -> DataFrame:
    """Every rule as one small DataFrame; those on dimensions when the dimensions are given."""
    if dim_title is None or dim_region is None or dim_date is None:
        return fact_checks(fact, min_rows)
    dims = {"dim_title": dim_title, "dim_region": dim_region, "dim_date": dim_date}
    out = fact_checks(fact, min_rows, dims)
    for name, dim in dims.items():
        out = out.unionByName(dimension_checks(name, dim))
    return out


# ---- rules over loads -------------------------------------------------------------------------------
#: What the rules need to know of some facts: (kind 'rule', name, null, violations), (kind 'key', dimension, key, rows).
STATE_SCHEMA = "kind string, name string, value string, n long"


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: ``__dups``, the keys with several rows (null is one). Hashes of 8 bytes are counted in place of keys;
    only keys whose hash comes more than once, nearly always none but the repeated ones, are counted themselves."""
    hashed = df.select(key, F.xxhash64(key).alias("__hash"))
    often = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).select("__hash")
    # stored, so that its size is known before the keys would be shuffled to meet it
    again = hashed.join(stored(often, "repeated-hashes"), "__hash", "left_semi")
    return duplicate_keys(again, key).agg(F.count(F.lit(1)).alias("__dups"))


def fact_state(batch: DataFrame) -> DataFrame:
    """The rules' state of the facts of one load; states add up over loads (see :func:`check_states`). ``batch`` is
    read several times; pass a stored one."""
    faults = _row_faults()
    found = batch.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(c).alias(n) for n, c in faults.items()]).join(
        repeated_keys(batch, "performance_id"))
    pairs = [(n, n) for n in faults] + [("fact_rows", "__rows"), ("performance_id_unique", "__dups")]
    rules = _rows(found, pairs).select(
        F.lit("rule").alias("kind"), F.col("rule").alias("name"), F.lit(None).cast("string").alias("value"), F.col("violations").alias("n"))
    names = F.inline(F.array(*[F.struct(F.lit(name).alias("name"), F.col(key).cast("string").alias("value"))
                               for name, (key, _) in DIMENSIONS.items()]))
    keys = batch.select(names).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    return rules.unionByName(keys.select(F.lit("key").alias("kind"), "name", "value", "n"))


def check_states(states: DataFrame, dim_title: DataFrame, dim_region: DataFrame, dim_date: DataFrame,
                 min_rows: int = MIN_FACT_ROWS) -> DataFrame:
    """The report of :func:`check_all` from the states of all loads and the dimensions, without the facts.

    Loads that insert absent keys only cannot repeat one another's, so repeated ids add up over loads. Keys are
    looked up in the dimensions as they are now."""
    rules = states.filter("kind = 'rule'").groupBy("name").agg(F.sum("n").alias("n"))
    short = F.greatest(F.lit(min_rows + 1) - F.col("n"), F.lit(0))
    out = rules.select(
        F.when(F.col("name") == "fact_rows", F.lit(f"fact_row_count_above_{min_rows}")).otherwise(F.col("name")).alias("rule"),
        F.when(F.col("name") == "fact_rows", short).otherwise(F.col("n")).cast("long").alias("violations"))
    dims = {"dim_title": dim_title, "dim_region": dim_region, "dim_date": dim_date}
    keys = states.filter("kind = 'key'").groupBy("name", "value").agg(F.sum("n").alias("n"))
    for name, dim in dims.items():
        key = DIMENSIONS[name][0]
        known = dim.select(F.col(key).cast("string").alias("value")).distinct()
        lost = keys.filter(F.col("name") == name).join(known, "value", "left_anti")
        out = out.unionByName(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations")).select(
            F.lit(f"fact_{name.removeprefix('dim_')}_in_{name}").alias("rule"), "violations"))
    out = out.withColumn("passed", F.col("violations") == 0)
    for name, dim in dims.items():
        out = out.unionByName(dimension_checks(name, dim))
    return out


def cleaner_coverage(raw_files: list[str], registry: dict) -> list[str]:
    """DQ9: raw files without a registered cleaner (empty list = every dataset covered)."""
    return sorted(f for f in raw_files if f not in registry or registry[f][1] is None)
