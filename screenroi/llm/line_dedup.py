"""Line dedup by overlapping windows of three lines.

Every three consecutive lines with text are a window, known by a 128-bit hash. Windows repeated
anywhere in the corpus are found with one aggregation (count and first place, combined on the map
side, so a window in a third of all documents is one row a task). Every later occurrence covers
its three lines; covered lines are merged and removed. Places are judged on the input, not on
what is left, and the first place of a window is (least doc_id, first line).

Only hashes and places shuffle to find repeats; texts are joined once, by document, with the lines
to remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import WHITE, materialize, row_keys, text_or_empty

WINDOW = 3


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc keys, at, hash): ``at`` is the array of line numbers of the window."""
    trimmed = F.transform(F.split(text_or_empty(), "\n"),
                          lambda x, i: F.struct(i.alias("line"), F.btrim(x, F.lit(WHITE)).alias("text")))
    lines = docs.select(*row_keys(), F.col("doc_id").isNull().alias("__no_id"),
                        F.filter(trimmed, lambda x: x["text"] != "").alias("lines"))
    size = F.size("lines")
    line = lambda i, k: F.get(F.col("lines"), i + k)
    windows = F.transform(
        F.sequence(F.lit(0), size - window),
        lambda i: F.struct(
            i.alias("at"),
            F.md5(F.concat_ws("\n", *[line(i, k)["text"] for k in range(window)]).cast("binary")).alias("hash"),
            F.array(*[line(i, k)["line"] for k in range(window)]).alias("covers")))
    return (lines.filter(size >= window)
            .select("__no_id", "__id", "__key", F.explode(windows).alias("w"))
            .select("__no_id", "__id", "__key", "w.at", F.unhex("w.hash").alias("hash"), "w.covers"))


def repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(__id, __key, gone): the line numbers, ascending, that later occurrences cover."""
    # the same document (id and text) in several rows is one document
    windows = materialize(_windows(docs, window), "line-windows")
    place = F.struct("__no_id", "__id", "__key", "at")
    firsts = materialize(
        windows.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first <> last").select("hash", "first"), "line-firsts")
    later = windows.join(firsts, "hash").filter(place != F.col("first"))
    return (later.select("__id", "__key", F.explode("covers").alias("line"))
            .groupBy("__id", "__key").agg(F.array_sort(F.collect_set("line")).alias("gone")))


def _flags(gone: Column) -> Column:
    """Array with '1' at each number in ``gone`` (ascending), '0' before and between them."""
    gaps = F.transform(gone, lambda g, i: F.repeat(F.lit("0"), g - F.coalesce(F.get(gone, i - 1), F.lit(-1)) - 1))
    return F.split(F.concat(F.array_join(gaps, "1"), F.lit("1")), "")


def line_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (reads doc_id, text) with ``text`` less its repeated lines, all columns, and
    ``__n_lines``, ``__n_removed``.

    Lines are what \\n separates, compared without white space at their ends. Lines of white space
    alone are no part of windows and stay. A text of fewer than three other lines keeps all; a null
    text stays null. A text can become empty; its row stays. Rows that repeat id and text are one
    document and get the same result; null ids come last in the order of places.
    """
    own = {"__doc_" + n: c for n, c in zip(("id", "key"), row_keys(), strict=True)}
    gone = repeated_lines(docs, window).select(
        F.col("__id").alias("__doc_id"), F.col("__key").alias("__doc_key"), F.col("gone").alias("__gone"))
    # lines and flags are columns of their own, so that they are computed once a row
    joined = docs.withColumns(own).join(gone, ["__doc_id", "__doc_key"], "left").withColumns(
        {"__lines": F.split(text_or_empty(), "\n"), "__flags": _flags(F.col("__gone"))})
    kept = F.array_join(F.filter("__lines", lambda x, i: F.coalesce(F.get("__flags", i), F.lit("0")) == "0"), "\n")
    return joined.select(
        *[F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept).alias("text")
          if c == "text" else F.col(c) for c in docs.columns],
        F.size("__lines").cast("long").alias("__n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("__n_removed"))


def without_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    return line_dedup(docs, window).select(*docs.columns)


def line_dedup_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, kept_sha256 (of the text that is left)."""
    return line_dedup(docs.select("doc_id", "text"), window).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"))
