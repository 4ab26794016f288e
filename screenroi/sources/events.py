"""Play events as JSON Lines under ``root/year=YYYY/month=MM/day=DD/``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import by_partition

# The seven-field play-event record.
PLAY_EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("title_id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("watch_duration_mins", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("region", T.StringType()),
    T.StructField("device", T.StringType()),
])


def read_play_events(spark: SparkSession, path: str, streaming: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Batch or streaming read with the fixed schema (a stream needs one). Event time is
    ``timestamp_ntz``: wall-clock time as written, independent of the session time zone."""
    if streaming:
        reader = spark.readStream.schema(PLAY_EVENT_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        return reader.option("recursiveFileLookup", True).json(path)
    return spark.read.schema(PLAY_EVENT_SCHEMA).option("recursiveFileLookup", True).json(path)


def land_play_events(df: DataFrame, root: str, mode: str = "append") -> None:
    """Write events as JSON Lines partitioned by the event's year, month and day."""
    ts = F.col("timestamp").cast("timestamp_ntz")
    days = ["year", "month", "day"]
    dated = (
        df.withColumn("year", F.year(ts))
        .withColumn("month", F.lpad(F.month(ts).cast("string"), 2, "0"))
        .withColumn("day", F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"))
    )
    by_partition(dated, days).write.mode(mode).partitionBy(*days).json(root)
