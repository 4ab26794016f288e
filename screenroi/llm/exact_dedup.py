"""Exact dedup: a two-pass Bloom filter keeps unrepeated texts out of the shuffle.

Each row is reduced to (row, doc_id, length, SHA-256 of the text without white space), written
once. Pass one sets two slots per hash in a bit array and finds the slots that two or more rows
set; packed into pages of 4 KB these are the Bloom filter of *possibly repeated* hashes. Pass two
probes the filter: a row whose slots are not both set again cannot have a twin and passes
straight through. Only the rest shuffles, and is resolved exactly on the full SHA-256, so a false
positive costs a little shuffle and never a wrong answer.

The filter has ``filter_bits`` bits at most, whatever the input: that is the bound on what is
broadcast. With more rows than it can tell apart it lets more rows through to the exact step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import WHITE_CLASS, materialize, text_or_empty

#: Most bits of the filter: 2**28 bits are 32 MB broadcast. Slots per row aimed for below it.
FILTER_BITS = 1 << 28
BITS_PER_ROW = 16
PAGE_BITS = 32768  # what one bitmap_construct_agg holds


def _slots(bits: int) -> list[Column]:
    h = F.xxhash64("sha")
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def possibly_repeated_filter(digests: DataFrame, bits: int) -> DataFrame:
    """Pass one: (page, bitmap) of the slots that at least two rows set."""
    slots = digests.select(F.explode(F.array(*_slots(bits))).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.groupBy(F.shiftright("slot", 15).alias("page")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(PAGE_BITS - 1))).alias("bitmap"))


def _probe(digests: DataFrame, pages: DataFrame, bits: int) -> DataFrame:
    """Pass two: ``digests`` with ``maybe``, false where the filter rules a twin out."""
    out = digests
    hit = F.lit(True)
    for k, slot in enumerate(_slots(bits)):
        page = F.broadcast(pages.select(F.col("page").alias(f"page{k}"),
                                        F.col("bitmap").alias(f"bitmap{k}")))
        out = out.withColumn(f"slot{k}", slot).withColumn(f"page{k}", F.shiftright(f"slot{k}", 15))
        out = out.join(page, f"page{k}", "left")
        at = F.col(f"slot{k}").bitwiseAND(F.lit(PAGE_BITS - 1))
        byte = F.conv(F.hex(F.substring(F.col(f"bitmap{k}"), F.shiftright(at, 3).cast("int") + 1,
                                        F.lit(1))), 16, 10).cast("int")
        bit = F.expr(f"shiftleft(1, cast(slot{k} & 7 as int))")
        hit = hit & F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))
    return out.select(*digests.columns, hit.alias("maybe"))


def exact_dedup(docs: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs`` (columns ``doc_id``, ``text``; others are not read):
    doc_id, keep_id, group_size, kept, text_sha256.

    Equal: identical after deleting white space. The row with the longest original text stays,
    then the smallest doc_id (null last), then the first of fully repeated rows, so exactly one
    row of a group is ``kept``. A null text counts as empty; all empty texts are one group. An
    empty table gives no rows. ``keep_id`` is null when the staying row has no id.
    """
    text = text_or_empty()
    digests = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(text).alias("points"),
        F.unhex(F.sha2(F.regexp_replace(text, WHITE_CLASS + "+", "").cast("binary"), 256)).alias("sha"),
    ), "exact-digests")
    bits = 1 << 20
    rows = digests.count()
    while bits < BITS_PER_ROW * rows and bits < filter_bits:
        bits *= 2
    pages = materialize(possibly_repeated_filter(digests, bits), "exact-filter")
    probed = _probe(digests, pages, bits)

    rank = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id"), F.col("row"))
    groups = materialize(
        probed.filter("maybe").groupBy("sha").agg(F.min(rank).alias("best"), F.count("*").alias("n"))
        .filter("n > 1").select("sha", F.col("best.doc_id").alias("best_id"),
                                F.col("best.row").alias("best_row"), "n"), "exact-groups")
    alone = probed.filter("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    grouped = probed.filter("maybe").join(groups, "sha", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("best_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
    return alone.unionByName(grouped)
