"""Curated sets that take in one landing at a time.

A curated set keeps one row per key, the smallest (``dedupe.keep_first``). The smallest of the smallest is the
smallest of all, so landings may come in any order and any number of times. ``CuratedStore`` keeps the set in folders
by a bucket of the key: a landing meets the stored rows of the buckets its keys fall into, and only those buckets
are written again, by dynamic partition overwrite. Each landing costs what its buckets hold, so take many buckets
where a landing has few keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_names, path_exists, scratch_path, stored
from .dedupe import keep_first

BUCKET = "key_bucket"
#: Into how many tasks a bucket is dealt.
PARTS = 16
_PART, _NEW = "__part", "__new"


class CuratedStore:
    """One row per ``keys`` under ``path``; ``order`` as in ``keep_first``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] | None = None, buckets: int = 64):
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path.rstrip("/"), list(keys), order, buckets

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def table(self, like: DataFrame) -> DataFrame:
        """The stored rows, in the columns of ``like``."""
        schema = like.limit(0).withColumn(BUCKET, F.lit(0)).schema
        return self.spark.read.schema(schema).parquet(self.path).select(*like.columns, BUCKET)

    def _merge(self, rows: DataFrame) -> DataFrame:
        """One row a key. Rows move by bucket and part, so that a bucket is at most ``PARTS`` files and need not be
        dealt again for the write; bucket and part follow from the key, so they order nothing."""
        part = F.pmod(F.xxhash64(F.xxhash64(*self.keys)), F.lit(PARTS)).cast("int")
        dealt = rows.withColumn(_PART, part).repartition(BUCKET, _PART)
        return keep_first(dealt, [BUCKET, _PART, *self.keys], self.order).drop(_PART)

    def _write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def upsert(self, landing: DataFrame) -> list[int]:
        """Takes in ``landing``; returns the buckets written. Rows that are stored already just so touch nothing. The
        merged rows are written aside first, so the set is never read while it is overwritten."""
        own = landing.withColumn(BUCKET, self._bucket())
        if not path_exists(self.spark, self.path):
            self._write(self._merge(own))
            return sorted(int(n.partition("=")[2]) for n in child_names(self.spark, self.path) if n.startswith(f"{BUCKET}="))
        own = stored(keep_first(landing, self.keys, self.order).withColumn(BUCKET, self._bucket()), "upsert-landing")
        met = [r[BUCKET] for r in own.select(BUCKET).distinct().collect()]  # at most `buckets`
        if not met:
            return []
        # between rows that are alike the stored one stays, so what has the mark afterwards is a change
        known = self.table(landing).filter(F.col(BUCKET).isin(met)).withColumn(_NEW, F.lit(False))
        path = scratch_path(self.spark, "upsert-merged")
        merged = self._merge(known.unionByName(own.withColumn(_NEW, F.lit(True))))
        merged.write.partitionBy(BUCKET).parquet(path)
        merged = self.spark.read.schema(merged.schema).parquet(path)
        touched = sorted(r[BUCKET] for r in merged.filter(_NEW).select(BUCKET).distinct().collect())
        if touched:
            self._write(merged.filter(F.col(BUCKET).isin(touched)).drop(_NEW))
        return touched
