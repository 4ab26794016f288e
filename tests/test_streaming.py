from pyspark.sql import functions as F

from screenroi.operators.metrics import prepare_usage, usage_by_title_region_year
from screenroi.sources.events import land_play_events, read_play_events
from screenroi.session import child_names
from screenroi.streaming.usage import (
    _FOLDERS, _USAGE_PARTS, Landing, compact_changelog, events_to_watch, read_latest, rows_dropped, start_daily_usage_stream,
    start_usage_refresh, start_windowed_usage, stream_usage,
)

from conftest import rows


def _events(spark, offset=0):
    data = []
    for i in range(60):
        day = 1 + (i % 4)
        data.append((f"u_{i % 7}", f"t{i % 3}", "play" if i % 5 else "pause", 10 + i + offset,
                     f"2024-03-{day:02d}T{(i % 24):02d}:{i % 60:02d}:00", ["US", "GB", " usa "][i % 3], "TV"))
    return spark.createDataFrame(data, "user_id string, title_id string, event string, watch_duration_mins int, "
                                       "timestamp string, region string, device string")


def test_stream_equals_batch(spark, scratch):
    src = f"{scratch}/src"
    land_play_events(_events(spark), src)
    # Files are picked up in no guaranteed order, one per micro-batch; a watermark longer than
    # the data's span means no event is late, so the stream must equal the batch result.
    q = start_daily_usage_stream(spark, src, f"{scratch}/out", f"{scratch}/ckpt", watermark="30 days",
                                 max_files_per_trigger=1)
    q.awaitTermination()
    keys = ["window_start", "window_end", "title_id", "region"]
    streamed = read_latest(spark, f"{scratch}/out", keys)
    batch = stream_usage(read_play_events(spark, src))
    assert rows(streamed.drop("approx_viewers")) == rows(batch.drop("approx_viewers"))
    assert streamed.filter(F.col("region") == "US").count() > 0


def test_watermark_drops_late_days(spark, scratch):
    src = f"{scratch}/src"
    ev = _events(spark)
    land_play_events(ev.filter(F.col("timestamp").startswith("2024-03-04")), src)
    args = (spark, src, f"{scratch}/out", f"{scratch}/ckpt")
    start_daily_usage_stream(*args, watermark="1 day").awaitTermination()
    # Day 1 arrives after day 4 was seen: it is more than a day behind the watermark.
    land_play_events(ev.filter(F.col("timestamp").startswith("2024-03-01")), src)
    late = start_daily_usage_stream(*args, watermark="1 day")
    late.awaitTermination()
    assert rows_dropped(late) > 0  # the loss can be seen
    days = {r.window_start.day for r in read_latest(spark, f"{scratch}/out",
                                                    ["window_start", "window_end", "title_id", "region"]).collect()}
    assert days == {4}


def test_refresh_stream_is_exact_and_replay_safe(spark, scratch):
    src = f"{scratch}/src"
    land_play_events(_events(spark), src)
    args = (spark, src, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt")
    start_usage_refresh(*args, max_files_per_trigger=2).awaitTermination()
    expected = usage_by_title_region_year(prepare_usage(events_to_watch(read_play_events(spark, src))))
    got = read_latest(spark, f"{scratch}/out", ["title_id", "region", "year"])
    assert rows(got) == rows(expected)
    # New files arrive; the same checkpoint picks up only them, and totals stay exact.
    land_play_events(_events(spark, offset=1000), src)
    start_usage_refresh(*args).awaitTermination()
    expected = usage_by_title_region_year(prepare_usage(events_to_watch(read_play_events(spark, src))))
    got = read_latest(spark, f"{scratch}/out", ["title_id", "region", "year"])
    assert rows(got) == rows(expected)


def test_refresh_keeps_events_without_a_time(spark, scratch):
    src = f"{scratch}/src"
    ev = spark.createDataFrame(
        [("u1", "t1", "play", 30, "2024-03-01T10:00:00", "US", "TV"), ("u2", "t1", "play", 20, None, "US", "TV")],
        "user_id string, title_id string, event string, watch_duration_mins int, timestamp string, region string, device string")
    for k in range(2):  # the group without a year is touched by both batches
        land_play_events(ev.withColumn("user_id", F.concat("user_id", F.lit(str(k)))), src)
        start_usage_refresh(spark, src, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt").awaitTermination()
    got = {r.year: (r.total_watch_hours, r.unique_viewers)
           for r in read_latest(spark, f"{scratch}/out", ["title_id", "region", "year"]).collect()}
    assert got == {2024: (1.0, 2), None: (40 / 60.0, 2)}


def test_refresh_compacts_and_stays_exact(spark, scratch):
    """Ten batches with a base every three: a batch looks at four folders at most, and totals stay exact."""
    src = f"{scratch}/src"
    columns = "user_id string, title_id string, event string, watch_duration_mins int, timestamp string, region string, device string"
    args = (spark, src, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt")
    for k in range(10):
        land_play_events(spark.createDataFrame(
            [(f"u{k % 4}", f"t{k % 3}", "play", 60 + k, "2024-03-01T10:00:00", "US", "TV"),
             (f"u{k}", f"own{k}", "play", 6, "2023-03-01T10:00:00", "US", "TV")], columns), src)
        start_usage_refresh(*args, compact_every=3).awaitTermination()
    expected = usage_by_title_region_year(prepare_usage(events_to_watch(read_play_events(spark, src))))
    assert rows(read_latest(spark, f"{scratch}/out", ["title_id", "region", "year"])) == rows(expected)
    assert child_names(spark, f"{scratch}/landing/bases") == ["upto=2", "upto=5", "upto=8"]
    # each batch wrote only the groups it touched
    assert spark.read.parquet(f"{scratch}/out").count() == 20
    plan = Landing(spark, f"{scratch}/landing", _USAGE_PARTS, _FOLDERS, 3).read(9)
    assert len({f.rsplit("/event_year", 1)[0] for f in plan.inputFiles()}) == 2  # the base of 8 and batch 9


KEYS = ["window_start", "window_end", "title_id", "region"]


def test_windows_keep_late_events(spark, scratch):
    """Days arrive newest first, one a run: the result is the batch result, and late plays are counted."""
    src = f"{scratch}/src"
    ev = _events(spark)
    args = (spark, src, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt")
    for day in (4, 3, 1, 2):
        land_play_events(ev.filter(F.col("timestamp").startswith(f"2024-03-0{day}")), src)
        start_windowed_usage(*args, watermark="1 day", compact_every=3).awaitTermination()
    got = read_latest(spark, f"{scratch}/out", KEYS)
    batch = stream_usage(read_play_events(spark, src))
    assert rows(got.drop("late_plays")) == rows(batch)
    late = {r.window_start.day: r.late for r in got.groupBy("window_start").agg(F.sum("late_plays").alias("late")).collect()}
    plays = {r.window_start.day: r.n for r in batch.groupBy("window_start").agg(F.sum("plays").alias("n")).collect()}
    assert late[4] == 0 and late[1] == plays[1] and late[2] == plays[2]
    # a base takes the place of the batches before it
    assert compact_changelog(spark, f"{scratch}/out", KEYS) == 3
    assert rows(read_latest(spark, f"{scratch}/out", KEYS)) == rows(got)
    land_play_events(ev.limit(7), src)
    start_windowed_usage(*args, compact_every=3).awaitTermination()
    assert rows(read_latest(spark, f"{scratch}/out", KEYS).drop("late_plays")) == rows(stream_usage(read_play_events(spark, src)))


def test_redelivered_events_change_nothing(spark, scratch):
    src = f"{scratch}/src"
    ev = _events(spark).unionByName(spark.createDataFrame(
        [("u1", "t1", "play", 9, None, "US", None)], _events(spark).schema))
    windows = (spark, src, f"{scratch}/w", f"{scratch}/w_out", f"{scratch}/w_ckpt")
    usage = (spark, src, f"{scratch}/u", f"{scratch}/u_out", f"{scratch}/u_ckpt")
    results = []
    for part in (ev.limit(40), ev, ev):
        land_play_events(part, src)
        start_windowed_usage(*windows, redelivered=True, compact_every=2).awaitTermination()
        start_usage_refresh(*usage, redelivered=True, compact_every=2).awaitTermination()
        results.append((rows(read_latest(spark, f"{scratch}/w_out", KEYS).drop("late_plays")),
                        rows(read_latest(spark, f"{scratch}/u_out", ["title_id", "region", "year"]))))
    once = f"{scratch}/once"
    land_play_events(ev, once)
    events = read_play_events(spark, once)
    assert results[1] == results[2]
    dated = events.filter("timestamp IS NOT NULL")
    assert results[2][0] == rows(stream_usage(dated))
    assert results[2][1] == rows(usage_by_title_region_year(prepare_usage(events_to_watch(events))))


def test_viewer_sketches_add_up(spark):
    from screenroi.operators.viewers import ERROR, roll_up, viewer_sketches

    plays = spark.range(60_000).selectExpr("concat('u', id % 9000) AS user_id", "concat('t', id % 2) AS title_id", "'US' AS region",
                                           "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 59 as int)) AS timestamp")
    months = {(r.title_id, str(r.month)): r for r in roll_up(viewer_sketches(plays)).collect()}
    for r in plays.groupBy("title_id", F.trunc("timestamp", "month").alias("month")).agg(
            F.count_distinct("user_id").alias("n"), F.count("*").alias("plays")).collect():
        found = months.pop((r.title_id, str(r.month)))
        assert found.plays == r.plays and abs(found.viewers - r.n) <= ERROR * r.n
    assert not months
