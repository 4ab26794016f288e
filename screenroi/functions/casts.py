"""Lenient, ANSI-safe casts.

The pipeline's contract is "a value that does not parse becomes null", the behaviour of a
non-ANSI runtime. Spark 4 runs with ANSI on, where ``cast`` throws, so every cast here is a
``try_cast`` / ``try_to_date`` / ``try_to_timestamp`` chosen by the *source* type, which keeps
the work inside whole-stage codegen (no UDFs).

Text is read as string by our CSV readers (no inference pass), so text-specific rules apply:

* integers accept decimal text and truncate toward zero (``'3.5'`` -> 3), as a non-ANSI cast of
  an inferred double column would;
* booleans accept the Spark boolean words (true/false, t/f, yes/no, y/n, 1/0) and any numeric
  text (non-zero is true), so ``'1.0'`` is true;
* dates and timestamps use Spark's cast grammar (``'2024-3-1'`` parses, ``'03/01/2024'`` and
  ``'2024-02-30'`` are null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIME = (T.TimestampType, T.TimestampNTZType)


def _source_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def lenient(col: Column, source: T.DataType, target: str) -> Column:
    """Cast ``col`` (of type ``source``) to ``target``; bad values become null."""
    target = target.lower()
    if target == "string":
        return col.cast("string")
    if target in ("int", "integer", "long", "bigint", "short", "smallint"):
        if isinstance(source, T.StringType):
            return F.coalesce(col.try_cast(target), col.try_cast("double").try_cast(target))
        if isinstance(source, T.BooleanType):
            return col.cast(target)
        return col.try_cast(target)
    if target in ("double", "float"):
        return col.try_cast(target)
    if target.startswith("decimal"):
        return col.try_cast(target)
    if target == "boolean":
        if isinstance(source, T.BooleanType):
            return col
        if isinstance(source, T.StringType):
            return F.coalesce(col.try_cast("boolean"), col.try_cast("double") != F.lit(0.0))
        if isinstance(source, _NUMERIC):
            return col != F.lit(0)
        return col.try_cast("boolean")
    if target == "date":
        if isinstance(source, T.DateType):
            return col
        if isinstance(source, _TIME):
            return F.to_date(col)
        if isinstance(source, T.StringType):
            return F.try_to_date(col)
        return col.try_cast("date")
    if target == "timestamp":
        if isinstance(source, T.TimestampType):
            return col
        if isinstance(source, (T.DateType, T.TimestampNTZType)):
            return col.cast("timestamp")
        if isinstance(source, T.StringType):
            return F.try_to_timestamp(col)
        return col.try_cast("timestamp")
    return col.try_cast(target)


def cast_column(df: DataFrame, name: str, target: str) -> Column:
    """Lenient cast of column ``name`` of ``df`` to ``target`` (type read from the schema)."""
    return lenient(F.col(name), _source_type(df, name), target)


def optional(df: DataFrame, name: str | None, target: str) -> Column:
    """The lenient cast of ``name`` if present, else a typed null (missing optional columns
    never fail the job)."""
    if name is None or name not in df.columns:
        return F.lit(None).cast(target)
    return cast_column(df, name, target)
