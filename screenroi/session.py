"""Session construction and the shared scratch location.

Intermediate tables and stream checkpoints go under the folder the cluster names in
``spark.checkpoint.dir``. When that setting is absent, a local session gets one below the
warehouse directory; on a cluster it is an error.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "screenroi",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session with the settings the jobs assume (UTC, AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream checkpoints.

    Reads ``spark.checkpoint.dir`` from the session (or the context's checkpoint dir).
    If neither is set, a local master gets a folder below ``spark.sql.warehouse.dir``, installed
    as the context's checkpoint dir so that ``DataFrame.checkpoint`` uses the same place; on any
    other master that is an error.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local context; the server's conf rules
        sc = None
    if not configured and sc is not None:
        configured = sc.getCheckpointDir()
    if not configured:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                f"Set {CHECKPOINT_CONF} to a folder that the driver and all executors share: "
                "without it intermediate tables would be written to each machine's own disk.")
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        configured = warehouse.rstrip("/") + "/_screenroi_scratch"
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system the path belongs to."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hpath)
    return sorted(f.getPath().getName() for f in found)


def file_stamps(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(name, length, time of change) of every file below ``path``, in order."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(hpath, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


#: Input (Parquet bytes) a shuffle task answers for. Compressed columns of 4 MB become some 300 MB in the sorts of a task.
TASK_INPUT = 4 << 20
#: What adaptive execution may put into one task, and what a scan task reads, once the input is large. Shuffled bytes
#: take some 30 times their size in sorts, so the 64 MB of Spark's default would spill.
_LARGE = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.files.maxPartitionBytes": "16m"}
_PARTITIONS, _SIZED = "spark.sql.shuffle.partitions", "screenroi.sized"


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Sizes the session's shuffles for a job that reads ``input_bytes``, so that the memory of a task does not
    grow with the input; returns how many tasks of ``TASK_INPUT`` that is. Never below what the session was set to:
    a job that needs no more tasks than that finds the session's own settings (again)."""
    tasks = -(-input_bytes // TASK_INPUT)
    for key, (before, ours) in json.loads(spark.conf.get(_SIZED, "{}")).items():
        if spark.conf.get(key, None) == ours:  # else it was set again since, which counts
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    sized = {}
    if tasks > int(spark.conf.get(_PARTITIONS)):
        for key, ours in ({_PARTITIONS: str(tasks)} | _LARGE).items():
            sized[key] = (spark.conf.get(key, None), ours)
            spark.conf.set(key, ours)
    spark.conf.set(_SIZED, json.dumps(sized))
    return tasks


#: For what is written: ids in hexadecimal digits take half the bytes of the default codec.
CODEC = "zstd"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the scratch folder and read back: cuts the lineage, keeps
    column pruning and statistics, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the scratch root for one run of one job."""
    return f"{scratch_root(spark)}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
