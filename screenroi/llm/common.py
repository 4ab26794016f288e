"""Helpers the training-data operators share."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenroi.session import scratch_path

#: The white space of every operator here: blank and \t \n \x0B \f \r, nothing else.
WHITE = " \t\n\x0b\f\r"
WHITE_CLASS = "[\\x20\\x09-\\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage at a table that every executor can reread, so a lost executor costs only
    its running tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def row_keys() -> list[Column]:
    """Two never-null columns that identify a document by id and text.

    Rows that repeat both are one document; rows that share an id but not the text are two.
    """
    return [
        F.coalesce(F.col("doc_id"), F.lit(0)).alias("__id"),
        F.xxhash64(text_or_empty(), F.col("doc_id").isNull()).alias("__key"),
    ]


def ship_package(spark: SparkSession) -> None:
    """Let Spark deliver this package to the executors, for operators that run Python there."""
    sc = spark.sparkContext
    archive = os.path.join(sc._temp_dir, "screenroi.zip")  # Spark's own folder on the driver
    if os.path.exists(archive):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)


def without(docs: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    """``docs`` less the documents whose :func:`row_keys` are in ``keys`` (or only them, by
    ``left_semi``), with all columns. Spark broadcasts ``keys`` if it proves small."""
    own = docs.withColumns({"__doc_" + name: column for name, column in zip(("id", "key"), row_keys(), strict=True)})
    found = keys.select(F.col("__id").alias("__doc_id"), F.col("__key").alias("__doc_key"))
    return own.join(found, ["__doc_id", "__doc_key"], how).select(*docs.columns)
