"""Digests of keys: Bloom filters in words of 64 bits, as rows of a table.

A key sets four bits of one word, ``slot``. A digest is (slot, bits), at most ``words`` rows however many keys it
stands for, added up with ``bit_or`` on the map side. A key whose bits are not all there was never in; one whose
bits are may have been. A look-up is one equi-join on the slot, and the size of one digest has a bound, so it is
broadcast. Some 6 keys a word let about 2 in 100 others through; more keys let more through, never fewer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 bytes a word: 2 MB, for some 800,000 keys.
WORDS = 1 << 17


def _slot(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _bits(key: Column) -> Column:
    second = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    found = None
    for k in range(4):
        bit = F.call_function("shiftleft", one, F.shiftright(second, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        found = bit if found is None else found.bitwiseOR(bit)
    return found


def key_digest(rows: DataFrame, key: str, by: Sequence[str] = (), words: int = WORDS) -> DataFrame:
    """(by, slot, bits) of the keys of ``rows``, for each group ``by``; null keys are in none."""
    keys = rows.filter(F.col(key).isNotNull()).select(*by, _slot(F.col(key), words).alias("slot"), _bits(F.col(key)).alias("bits"))
    return merge_digests(keys, by)


def merge_digests(digests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return digests.groupBy(*by, "slot").agg(F.bit_or("bits").alias("bits"))


def split_by_digest(rows: DataFrame, key: str, digest: DataFrame, by: Sequence[str] = (),
                    words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the digest of their group, rows whose key is in none of it). Null keys are
    of the second kind."""
    own = rows.withColumns({"__slot": _slot(F.col(key), words), "__bits": _bits(F.col(key))})
    theirs = digest.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("slot").alias("__there"), F.col("bits").alias("__in"))
    if not by:  # `words` rows at most; one digest a group is Spark's to weigh
        theirs = F.broadcast(theirs)
    meets = (F.col("__slot") == F.col("__there")) & F.col(key).isNotNull() & (
        F.col("__in").bitwiseAND(F.col("__bits")) == F.col("__bits"))
    for c in by:
        meets = meets & (F.col(c) == F.col(f"__{c}"))
    return tuple(own.join(theirs, meets, how).select(*rows.columns) for how in ("left_semi", "left_anti"))
