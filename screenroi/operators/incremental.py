"""Loads that read what a batch can touch, and tables that keep their distribution.

``FactStore`` keeps the fact in folders by ``date_id`` with a digest of the stored keys of each. A load looks its
batch up in the digests first: rows that are surely new go straight on, the others meet the stored keys of their
own dates alone (partitions pruned by the batch, at run time). A ``performance_id`` is made of title, region and year, so
a key is always stored under the date of its year; for keys that are not, use ``warehouse.new_fact_rows``. Such ids are
neither moved nor stored (64 digits that do not pack): files hold an id only where it is another, ``table`` gives all.

Each load leaves its state of the quality rules beside the fact, so that the report after many loads reads the
states and the dimensions, no facts.

``write_bucketed`` stores catalog tables in buckets by title, sorted inside, so that joins and aggregations by title
need no exchange however often they are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.domain import performance_key
from ..session import CODEC, child_names, path_exists, stored
from ..sources.files import by_partition
from .dedupe import keep_first
from .digest import WORDS, key_digest, merge_digests, split_by_digest
from .quality import MIN_FACT_ROWS, STATE_SCHEMA, check_states, fact_state
from .warehouse import FACT_SCHEMA, fact_rows

KEY, DATE = "performance_id", "date_id"
_LEAST_DATE = -(1 << 31)
#: Digests of the dates of a batch up to so many bytes are sent to every task, in place of dealing the batch by them.
BROADCAST_DIGESTS = 32 << 20
_OWN, _HASH, _THEIR = "__own_id", "__hash", "__their_"


def _made_id(prefix: str = "") -> Column:
    return performance_key(F.col(f"{prefix}title_id"), F.col(f"{prefix}region_code"), F.expr(f"{prefix}{DATE} div 10000"))


def without_made_ids(facts: DataFrame) -> DataFrame:
    """``facts`` with an id only where it is not the one made of the row's title, region and year: 64 bytes less to move
    and store of nearly every row. ``with_made_ids`` restores them."""
    return facts.withColumn(_OWN, F.nullif(F.col(KEY), _made_id())).drop(KEY)


def with_made_ids(facts: DataFrame) -> DataFrame:
    return facts.withColumn(KEY, F.coalesce(F.col(_OWN), _made_id())).select(*FACT_SCHEMA.fieldNames())


def absent_facts(facts: DataFrame, others: DataFrame) -> DataFrame:
    """``facts`` whose date and id are not among those of ``others``. Both are dealt by hashes without made ids, which are
    compared as made again where they meet."""
    mine, theirs = (without_made_ids(df.withColumn(_HASH, F.xxhash64(KEY))) for df in (facts, others))
    theirs = theirs.select(*[F.col(c).alias(f"{_THEIR}{c}") for c in (_HASH, DATE, "title_id", "region_code", _OWN)])
    same_id = F.coalesce(F.col(_OWN), _made_id()) == F.coalesce(F.col(f"{_THEIR}{_OWN}"), _made_id(_THEIR))
    meets = (F.col(_HASH) == F.col(f"{_THEIR}{_HASH}")) & (F.col(DATE) == F.col(f"{_THEIR}{DATE}")) & same_id
    return with_made_ids(mine.join(theirs, meets, "left_anti"))


class FactStore:
    """The fact under ``root``: ``fact/load=N/date_id=.../``, ``digest/load=N/`` (date_id, slot, bits) and ``state/load=N/``
    (quality rules). A load counts from the moment its facts are finished."""

    def __init__(self, spark: SparkSession, root: str, words: int = WORDS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.words = words

    def _loads(self, part: str) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in child_names(self.spark, f"{self.root}/{part}") if n.startswith("load="))

    def _finished(self) -> list[int]:
        return [n for n in self._loads("fact") if path_exists(self.spark, f"{self.root}/fact/load={n}/_SUCCESS")]

    def table(self) -> DataFrame | None:
        """All stored facts; None before the first load."""
        paths = [f"{self.root}/fact/load={n}" for n in self._finished()]
        if not paths:
            return None
        rows = self.spark.read.schema(FACT_SCHEMA).option("basePath", f"{self.root}/fact").parquet(*paths)
        return rows.withColumn(KEY, F.coalesce(F.col(KEY), _made_id())).select(*FACT_SCHEMA.fieldNames())

    def digests(self) -> DataFrame | None:
        """Digests of the stored keys of each date, of all loads together; bounded by dates and words."""
        loads = self._loads("digest")
        if not loads:
            return None
        rows = self.spark.read.schema("date_id int, slot int, bits bigint").parquet(*[f"{self.root}/digest/load={n}" for n in loads])
        return merge_digests(rows, [DATE])

    def new_rows(self, staging: DataFrame, dedupe: bool = False) -> DataFrame:
        """Facts of ``staging`` whose key is not stored. Rows of one new key inside the batch are all new, unless
        ``dedupe`` keeps one."""
        batch = fact_rows(staging)
        if dedupe:
            batch = keep_first(batch, [KEY])
        table, digests = self.table(), self.digests()
        if table is None or digests is None:
            return batch
        dates = batch.select(DATE).distinct()  # one row a date of the batch
        met = digests.join(F.broadcast(dates), DATE, "left_semi")
        stored_dates = {n for load in self._loads("fact") for n in child_names(self.spark, f"{self.root}/fact/load={load}") if n.startswith(f"{DATE}=")}
        if len(stored_dates) * self.words * 16 <= BROADCAST_DIGESTS:
            met = F.broadcast(met)
        maybe, new = split_by_digest(batch, KEY, met, [DATE], self.words)
        # a comparison, if one that all dates pass, lets Spark prune the table's partitions by what it finds at run time
        touched = maybe.select(DATE).filter(F.col(DATE) >= _LEAST_DATE).distinct()
        return new.unionByName(absent_facts(maybe, table.join(F.broadcast(touched), DATE, "left_semi")))

    def load(self, staging: DataFrame, dedupe: bool = False) -> int:
        """Appends the new facts and returns their number. The digest goes first: a load that breaks off in
        between leaves keys that may be stored, and its repetition looks them up."""
        slim = stored(without_made_ids(self.new_rows(staging, dedupe)), "fact-new")
        rows = with_made_ids(slim)
        number = max(self._loads("digest"), default=-1) + 1
        key_digest(rows, KEY, [DATE], self.words).write.mode("overwrite").parquet(f"{self.root}/digest/load={number}")
        fact_state(rows).write.mode("overwrite").parquet(f"{self.root}/state/load={number}")
        dealt = by_partition(slim, [DATE]).withColumnRenamed(_OWN, KEY).select(*FACT_SCHEMA.fieldNames())
        dealt.sortWithinPartitions(DATE, "region_code", "title_id").write.mode("overwrite").option("compression", CODEC).partitionBy(
            DATE).parquet(f"{self.root}/fact/load={number}")
        return rows.count()

    def states(self) -> DataFrame:
        """Quality states of the finished loads."""
        paths = [f"{self.root}/state/load={n}" for n in self._finished()]
        if not paths:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(*paths)

    def check(self, dim_title: DataFrame, dim_region: DataFrame, dim_date: DataFrame, min_rows: int = MIN_FACT_ROWS) -> DataFrame:
        """``quality.check_all`` of the stored facts, from the states of the loads."""
        return check_states(self.states(), dim_title, dim_region, dim_date, min_rows)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "title_id",
                   sort_by: Sequence[str] = ("title_id",), mode: str = "overwrite") -> DataFrame:
    """``df`` as catalog table ``table`` at ``path`` in ``buckets`` by ``key``, sorted by ``sort_by`` inside."""
    # one task a bucket, so that each bucket is one file a write
    rows = df.repartition(buckets, key)
    rows.write.mode(mode).bucketBy(buckets, key).sortBy(*sort_by).option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def order_breaks(table: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    """One row (n_rows, breaks): how many rows of the table's files follow a larger one of the same file."""
    from pyspark.sql import Window

    rows = table.select(F.struct(*sort_by).alias("key"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    before = F.lag("key").over(Window.partitionBy("file", "block").orderBy("place"))
    return rows.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") > F.col("key")).alias("breaks"))
