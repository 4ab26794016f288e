"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, source mixing, packing.

``STAGES`` are run in order over ``documents``. Every stage but the last returns the columns of
documents; each result is written as Parquet and read by the next stage.

In every stage null texts count as empty, null ids, languages and sources are values of their own, further columns pass
through (but for the last), an empty table stays empty, and long texts are read whole. Rows that repeat id and text
are kept or dropped together, except that verdicts of the first stage hold for a row's own language and source, and that
one row of a group of near copies stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, read_table
from screenroi.llm.line_dedup import without_repeated_lines
from screenroi.llm.mixing import mix_sources
from screenroi.llm.packing import pack_documents
from screenroi.llm.quality_rules import keep_quality
from screenroi.llm.simhash import keep_one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep."""
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines of three-line windows that occur earlier; ``n_chars`` follows."""
    out = without_repeated_lines(docs)
    if "n_chars" not in out.columns:
        return out
    kind = out.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), "n_chars"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (fingerprints of 3-word shingles, 2 bits)."""
    return keep_one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the tempered weight of their source asks, none left out."""
    return mix_sources(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", packing),
]

#: Components of SimHash links, tokens and packing are not SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
