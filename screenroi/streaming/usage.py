"""Structured Streaming usage jobs over play events.

* ``events_to_watch``: play events -> watch-history shape (batch or stream).
* ``stream_usage``: event-time tumbling windows per title and region with a watermark
  (bounded state); distinct viewers are approximate (HLL++) because exact distinct is not
  supported on streams.
* ``start_daily_usage_stream``: runs ``stream_usage`` in update mode into a *changelog*
  table: every micro-batch writes the groups it changed to ``batch_id=N`` (overwritten on
  replay, so a retried batch is idempotent); ``read_latest`` keeps the newest row per group.
* ``start_usage_refresh``: every micro-batch lands its usage parts (exact sums of minutes by group, and
  viewers), then recomputes **exact** usage for the (title, region, year) groups it touched, from
  the landed parts of those titles, and writes them to the changelog.
* ``start_windowed_usage``: windows as mergeable sums and viewer sketches, so that late events count and
  redelivered ones need not.
Checkpoints and tables live in shared storage given by the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.domain import normalize_region
from ..operators.metrics import merge_usage_parts, prepare_usage, usage_from_parts, usage_parts
from ..session import child_names, path_exists, stored
from ..sources.events import read_play_events
from ..sources.files import by_partition

PLAY = "play"


def events_to_watch(events: DataFrame) -> DataFrame:
    """Only ``event = 'play'`` rows, in a shape ``prepare_usage`` understands."""
    return events.filter(F.col("event") == PLAY).select(
        "user_id", "title_id", "watch_duration_mins", "timestamp", "region", "device"
    )


def window_plays(events: DataFrame) -> DataFrame:
    """Plays with a title and minutes: title_id, region, user_id, watch_duration_mins, timestamp."""
    return events_to_watch(events).select(
        F.col("title_id").cast("string").alias("title_id"),
        normalize_region(F.col("region")).alias("region"),
        F.col("user_id"),
        F.col("watch_duration_mins").cast("long").alias("watch_duration_mins"),
        # Watermarks need TIMESTAMP; wall-clock event time is read in the session time zone
        # (jobs pin UTC), which keeps day windows aligned with calendar days.
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    ).filter(F.col("title_id").isNotNull() & F.col("watch_duration_mins").isNotNull())


def stream_usage(events: DataFrame, watermark: str = "1 day", window: str = "1 day",
                 approx_viewers: bool = True) -> DataFrame:
    """Per (window, title_id, region): watch minutes, plays and (optionally) approximate
    viewers. Works on batch and streaming DataFrames."""
    plays = window_plays(events)
    if events.isStreaming:
        plays = plays.withWatermark("timestamp", watermark)
    aggs = [
        F.sum("watch_duration_mins").alias("watch_minutes"),
        F.count(F.lit(1)).alias("plays"),
    ]
    if approx_viewers:
        aggs.append(F.approx_count_distinct("user_id").alias("approx_viewers"))
    out = plays.groupBy(F.window("timestamp", window).alias("w"), "title_id", "region").agg(*aggs)
    return out.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "title_id",
        "region",
        *[a for a in ("watch_minutes", "plays", "approx_viewers") if a in out.columns],
    )


def _numbered(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the finished sub-folders ``name=N``."""
    return sorted(int(n.partition("=")[2]) for n in child_names(spark, folder)
                  if n.startswith(f"{name}=") and path_exists(spark, f"{folder}/{n}/_SUCCESS"))


def _changelog(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    """Rows of a changelog from its last base on, as (batch_id, ...)."""
    batches = [n for n in _numbered(spark, path, "batch_id") if upto is None or n <= upto]
    base = max((n for n in _numbered(spark, f"{path}_bases", "upto") if upto is None or n < upto), default=None)
    parts = [(n, f"{path}/batch_id={n}") for n in batches if base is None or n > base]
    if base is not None:
        parts.insert(0, (base, f"{path}_bases/upto={base}"))
    out = None
    for number, part in parts:  # those since the last base
        one = spark.read.parquet(part).withColumn("batch_id", F.lit(number).cast("long"))
        out = one if out is None else out.unionByName(one)
    return out


def _latest(log: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("__v"))
    return latest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row per key of a changelog table written by the stream jobs (one aggregation
    with partial aggregation; no group is collected), read from its last base on."""
    log = _changelog(spark, path)
    if log is None:
        raise FileNotFoundError(f"No finished batch at {path}")
    return _latest(log, keys)


def compact_changelog(spark: SparkSession, path: str, keys: list[str]) -> int | None:
    """Writes the newest rows so far as a base beside the changelog, which readers start from; returns the
    last batch in it. Batches that come meanwhile are read on top."""
    batches = _numbered(spark, path, "batch_id")
    if not batches:
        return None
    _latest(_changelog(spark, path, batches[-1]), keys).write.mode("overwrite").parquet(f"{path}_bases/upto={batches[-1]}")
    return batches[-1]


def start_daily_usage_stream(spark: SparkSession, source: str, output: str, checkpoint: str,
                             watermark: str, window: str = "1 day",
                             approx_viewers: bool = True, available_now: bool = True,
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """STR3 as a running query: windowed usage in update mode into a changelog table.

    ``watermark`` is the caller's to choose: files are read in no given order, so it must span a
    backlog that is read in several micro-batches. ``rows_dropped`` tells whether it did."""
    events = read_play_events(spark, source, streaming=True, max_files_per_trigger=max_files_per_trigger)
    usage = stream_usage(events, watermark, window, approx_viewers)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = usage.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def rows_dropped(query: StreamingQuery) -> int:
    """Rows (after map-side aggregation) behind the watermark in the query's recent progress."""
    return sum(state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"])


#: Landed partial sums are dealt to so many folders a year, by title.
TITLE_BUCKETS = 64
_NO_YEAR = -1


#: Groups of landed parts; the folder keys besides title and region.
_GROUP = ("title_id", "region", "event_year", "bucket")


def _partials(batch: DataFrame) -> DataFrame:
    """The batch's usage parts, with the folder keys ``event_year`` (-1 where the event has no readable time)
    and ``bucket``."""
    plays = prepare_usage(events_to_watch(batch)).withColumns({
        "event_year": F.coalesce("year", F.lit(_NO_YEAR)),
        "bucket": F.pmod(F.xxhash64("title_id"), F.lit(TITLE_BUCKETS)).cast("int")})
    return usage_parts(plays, _GROUP)


_FOLDERS = ["event_year", "bucket"]
_USAGE_PARTS = "title_id string, region string, user_id string, band int, part decimal(38,0), event_year int, bucket int"
_SEEN = "seen_event string, seen_day string"
_WINDOW_PARTS = ("window_start timestamp, window_end timestamp, title_id string, region string, watch_minutes long, plays long, "
                 "late_plays long, viewers binary, day date, bucket int")


class Landing:
    """Rows landed by micro-batches in folders by ``folders``, with merged bases in between.

    A replayed batch overwrites its own folder, and reads only what batches before it landed."""

    def __init__(self, spark: SparkSession, root: str, schema: str, folders: list[str], every: int):
        self.spark, self.root, self.schema, self.folders, self.every = spark, root, schema, folders, every

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        return self._write(df, f"{self.root}/batches/batch_id={batch_id}")

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        by_partition(df, self.folders).write.mode("overwrite").partitionBy(*self.folders).parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def read(self, upto: int, bases_upto: int | None = None) -> DataFrame | None:
        """Rows of batches 0 to ``upto``: the last finished base (up to ``bases_upto``) and the batches after it."""
        last = upto if bases_upto is None else bases_upto
        base = max((k for k in _numbered(self.spark, f"{self.root}/bases", "upto") if k <= last), default=None)
        paths = [] if base is None else [f"{self.root}/bases/upto={base}"]
        paths += [f"{self.root}/batches/batch_id={k}" for k in range(0 if base is None else base + 1, upto + 1)]
        out = None
        for path in paths:  # at most `every` and one
            one = self.spark.read.schema(self.schema).parquet(path)
            out = one if out is None else out.unionByName(one)
        return out

    def compact(self, batch_id: int, merge: Callable[[DataFrame], DataFrame]) -> None:
        """After every ``every`` batches: what there is so far, merged, as a new base. From older bases only: a
        replay must not read the base it overwrites."""
        if batch_id % self.every == self.every - 1:
            self._write(merge(self.read(batch_id, batch_id - 1)), f"{self.root}/bases/upto={batch_id}")


# ---- events that are delivered again -----------------------------------------------------------------

_RECORD = ("user_id", "title_id", "event", "watch_duration_mins", "timestamp", "region", "device")


def first_deliveries(batch: DataFrame, seen: Landing, batch_id: int) -> DataFrame:
    """Events of a micro-batch that neither it nor an earlier one has delivered already: records without an id are
    the same if all their fields are. Names of seen events are kept by day of the event; a batch reads those of
    its own days, so an event may come again at any time later."""
    named = batch.withColumns({
        "seen_day": F.coalesce(F.to_date(F.col("timestamp").cast("timestamp")).cast("string"), F.lit("none")),
        "seen_event": F.md5(F.to_json(F.struct(*[F.col(c) for c in _RECORD])))}).dropDuplicates(["seen_day", "seen_event"])
    earlier = seen.read(batch_id - 1) if batch_id else None
    if earlier is not None:
        days = [r.seen_day for r in batch.select(F.coalesce(F.to_date(F.col("timestamp").cast("timestamp")).cast("string"), F.lit("none"))
                                                 .alias("seen_day")).distinct().collect()]  # days of one batch
        named = named.join(earlier.filter(F.col("seen_day").isin(days)), ["seen_day", "seen_event"], "left_anti")
    fresh = stored(named, "first-deliveries")
    seen.write(fresh.select("seen_day", "seen_event"), batch_id)
    seen.compact(batch_id, lambda rows: rows)
    return fresh.drop("seen_day", "seen_event")


# ---- windows that keep late events -------------------------------------------------------------------

#: Landed windows are dealt to so many folders a day, by title.
WINDOW_BUCKETS = 8
_WINDOW = ("window_start", "window_end", "title_id", "region")


def start_windowed_usage(spark: SparkSession, source: str, landing: str, output: str, checkpoint: str,
                         watermark: str = "1 day", window: str = "1 day", redelivered: bool = False,
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         compact_every: int = 20) -> StreamingQuery:
    """STR3 that loses no late event: windowed usage (minutes, plays, approximate viewers) into a changelog.

    Every micro-batch lands sums and viewer sketches of its windows in folders by day and window bucket, then reads
    back those of the windows it touched, however old, and writes their new totals. So files may come in any order.
    What arrives more than ``watermark`` behind the newest event of earlier batches counts as late:
    ``late_plays`` of its window, a subset of ``plays``. ``redelivered`` leaves out events delivered before."""
    events = read_play_events(spark, source, streaming=True, max_files_per_trigger=max_files_per_trigger)
    parts = Landing(spark, f"{landing}/parts", _WINDOW_PARTS, ["day", "bucket"], compact_every)
    seen = Landing(spark, f"{landing}/seen", _SEEN, ["seen_day"], compact_every)
    clock = f"{landing}/clock"
    keys = [*_WINDOW, "day", "bucket"]

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.sum("watch_minutes").alias("watch_minutes"), F.sum("plays").alias("plays"),
            F.sum("late_plays").alias("late_plays"), F.hll_union_agg("viewers").alias("viewers"))

    def process(batch: DataFrame, batch_id: int) -> None:
        if redelivered:
            batch = first_deliveries(batch, seen, batch_id)
        plays = window_plays(batch)
        newest = plays.agg(F.max("timestamp").alias("newest"))
        earlier = [n for n in _numbered(spark, clock, "batch_id") if n < batch_id]
        behind = F.lit(False)
        if earlier:
            before = spark.read.parquet(*[f"{clock}/batch_id={n}" for n in earlier[-1:]]).first().newest
            if before is not None:
                behind = F.coalesce(F.col("timestamp") < F.lit(before) - F.expr(f"INTERVAL {watermark}"), F.lit(False))
                newest = newest.select(F.greatest("newest", F.lit(before)).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{clock}/batch_id={batch_id}")
        windows = plays.groupBy(F.window("timestamp", window).alias("w"), "title_id", "region").agg(
            F.sum("watch_duration_mins").alias("watch_minutes"), F.count(F.lit(1)).alias("plays"),
            F.count_if(behind).alias("late_plays"), F.hll_sketch_agg("user_id").alias("viewers"))
        own = parts.write(windows.select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "title_id", "region", "watch_minutes", "plays",
            "late_plays", "viewers", F.to_date("w.start").alias("day"),
            F.pmod(F.xxhash64("title_id"), F.lit(WINDOW_BUCKETS)).cast("int").alias("bucket")), batch_id)
        parts.compact(batch_id, merge)
        # the days of the batch and at most WINDOW_BUCKETS values
        folders = own.agg(F.collect_set("day").alias("days"), F.collect_set("bucket").alias("buckets")).first()
        touched = own.select(*_WINDOW)
        all_parts = parts.read(batch_id).filter(F.col("day").isin(folders.days) & F.col("bucket").isin(folders.buckets))
        totals = merge(all_parts.join(touched, list(_WINDOW), "left_semi"))
        totals.select(*_WINDOW, "watch_minutes", "plays", "late_plays", F.hll_sketch_estimate("viewers").alias("approx_viewers")).write.mode(
            "overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_usage_refresh(spark: SparkSession, source: str, landing: str, output: str, checkpoint: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        compact_every: int = 20, redelivered: bool = False) -> StreamingQuery:
    """STR4: land each micro-batch as partial sums, then recompute exact usage of the groups it touched.

    A batch reads back only the folders of its own years and title buckets, and of those only its
    groups; raw events are never read again. Every ``compact_every`` batches the sums so far are
    merged into a new base, so a batch looks at that many folders at most. ``redelivered`` leaves out events
    that were delivered before (:func:`first_deliveries`)."""
    events = read_play_events(spark, source, streaming=True, max_files_per_trigger=max_files_per_trigger)

    parts = Landing(spark, landing, _USAGE_PARTS, _FOLDERS, compact_every)
    seen = Landing(spark, f"{landing}/seen", _SEEN, ["seen_day"], compact_every)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if redelivered:
            batch = first_deliveries(batch, seen, batch_id)
        landed = parts.write(_partials(batch), batch_id)
        parts.compact(batch_id, lambda rows: merge_usage_parts(rows, _GROUP))
        touched = landed.select("title_id", "region", "event_year").distinct()
        # at most TITLE_BUCKETS values, and the years of the batch
        own = landed.agg(F.collect_set("event_year").alias("years"), F.collect_set("bucket").alias("buckets")).first()
        pruned = parts.read(batch_id).filter(
            F.col("event_year").isin(own.years) & F.col("bucket").isin(own.buckets))
        own_parts = merge_usage_parts(pruned.join(touched, ["title_id", "region", "event_year"], "left_semi"), _GROUP)
        groups = usage_from_parts(own_parts, _GROUP)
        groups.select("title_id", "region", F.nullif("event_year", F.lit(_NO_YEAR)).alias("year"), "total_watch_hours",
                      "unique_viewers").write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(refresh)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
