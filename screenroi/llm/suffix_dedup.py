"""Removal of repeated byte strings by bucket-pointer refinement of suffixes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier (smaller doc_id,
or earlier in the same document). So all suffixes must be told apart by their first ``LENGTH`` bytes.
Sorting all of them would move many times the input; buckets are refined in three steps instead:

1. Initial q-gram buckets. Of the q-grams inside a string one is its representative (least hash,
   then leftmost), a function of the string alone. Consecutive strings share representatives, so a
   document has one q-gram bucket entry for about 35 bytes. Spark counts the buckets; strings in a
   bucket of one cannot repeat and go no further. Buckets of two or more are kept in a Bloom filter
   of fixed size (what it passes too much is found unrepeated later).
2. Each run of strings with one representative becomes a region of text (about 135 bytes). Equal
   regions in a batch are collapsed where they are read: only the first can be a first occurrence.
3. Regions are dealt by bucket. A task refines the suffixes of a bucket's different regions: 8-byte
   buckets, then each suffix is re-sorted by the bucket numbers at later offsets, 8, 16, 32 bytes on,
   using numbers of the refinement before, up to ``LENGTH``. The first suffix of a final bucket
   stays, the others give spans to remove.

A bucket with more than ``BUCKET_REGIONS`` regions (the edge of a passage that a third of all documents
quote) would not fit one task; its suffixes go on by a 128-bit name of their whole ``LENGTH`` bytes
and Spark combines the first place of each name on the map side.
Texts shuffle once at the end, with their spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, row_keys, ship_package, text_or_empty
from screenroi.llm.tokens import slices, utf8_bytes

LENGTH = 100
Q = 32
FILTER_BITS = 1 << 28
BITS_PER_BUCKET = 16
PAGE_BITS = 32768
BUCKET_REGIONS = 100_000
_CHUNK = 4 << 20
_REFINE_BYTES = 2 << 20

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def _grams8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place, as a number."""
    g = data.astype(np.uint64)
    for n in (1, 2, 4):
        g = g[:-n] | (g[n:] << np.uint64(8 * n))
    return g


def _names(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64-bit names of the ``length`` bytes (8 at least) from each place, by doubling."""
    h, n = _mix(_grams8(data) + np.uint64(seed * int(_A) % 2**64)), 8
    while n < length:
        step = min(n, length - n)
        h = _mix(h[:-step] * _A + h[step:])
        n += step
    return h


class Runs:
    """Runs of strings with one representative, over texts laid end to end.

    ``bucket`` names the representative q-gram; strings ``low`` to ``high`` (places in ``data``) have it.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int = LENGTH, q: int = Q):
        window = length - q + 1
        self.bucket = np.empty(0, np.uint64)
        self.low = self.high = self.row = np.empty(0, np.int64)
        if len(data) < length:
            return
        names = _names(data, q)
        # 32 bits of the name above, the place below: the least is the leftmost of the least names
        least = (names & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(names), dtype=np.uint64)
        n = 1
        while n < window:
            step = min(n, window - n)
            least = np.minimum(least[:-step], least[step:])
            n += step
        sizes = np.diff(ends)
        last = np.repeat(ends[1:] - length, sizes)[:len(least)]  # last string start of the place's text
        place = np.flatnonzero(np.arange(len(least)) <= last)
        at = (least[place] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        if not len(first):
            return
        self.bucket = _mix(names[at[first]] + _A)
        self.low = place[first]
        self.high = place[np.concatenate([first[1:], [len(place)]]) - 1]
        self.row = np.searchsorted(ends, self.low, side="right") - 1


def _bucket_counter(length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                runs = Runs(*utf8_bytes(part.column("text")), length, q)
                bucket, n = np.unique(runs.bucket, return_counts=True)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket.view(np.int64)), "n": pa.array(n, pa.int64())})

    return run


class BucketFilter:
    """Bloom filter of buckets with two probes."""

    def __init__(self, bits: int, pages: dict[int, bytes]):
        self.bits = bits
        self.bytes = np.zeros(bits // 8, np.uint8)
        for page, bitmap in pages.items():
            at = page * PAGE_BITS // 8
            self.bytes[at:at + PAGE_BITS // 8] = np.frombuffer(bitmap, np.uint8)[:len(self.bytes) - at]

    def probe(self, bucket: np.ndarray) -> np.ndarray:
        found = np.ones(len(bucket), bool)
        for slot in (bucket, bucket >> np.uint64(32)):
            slot = (slot & np.uint64(self.bits - 1)).astype(np.int64)
            found &= (self.bytes[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return found


def repeated_buckets(texts: DataFrame, length: int, q: int) -> DataFrame:
    """Step 1: (bucket, n) of the buckets with several entries."""
    counted = texts.select("text").mapInArrow(_bucket_counter(length, q), "bucket long, n long")
    return materialize(counted.groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 1"), "suffix-buckets")


def bucket_filter(repeated: DataFrame, filter_bits: int) -> BucketFilter:
    """Has at most ``filter_bits`` bits however many buckets repeat."""
    bits, most = PAGE_BITS, repeated.count()
    while bits < BITS_PER_BUCKET * most and bits < filter_bits:
        bits *= 2
    mask = F.lit(bits - 1)
    slots = repeated.select(F.explode(F.array(
        F.col("bucket").bitwiseAND(mask), F.shiftrightunsigned("bucket", 32).bitwiseAND(mask))).alias("slot"))
    pages = slots.groupBy(F.shiftright("slot", 15).alias("page")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(PAGE_BITS - 1))).alias("bitmap"))
    return BucketFilter(bits, {r.page: bytes(r.bitmap) for r in pages.toLocalIterator()})


REGIONS = "deal long, bucket long, region binary, __no_id boolean, __id long, __key long, start long, stop long"
SPANS = "__id long, __key long, start long, stop long"


def _gather(data: np.ndarray, low: np.ndarray, size: np.ndarray) -> pa.LargeBinaryArray:
    """Copies of data[low:low + size]."""
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(low - ends[:-1], size) + np.arange(ends[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(low), [None, pa.py_buffer(ends), pa.py_buffer(data[at])])


def _first_of_equal(regions: pa.LargeBinaryArray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, first): a number for each different region, and the least ``order`` it has."""
    coded = regions.dictionary_encode()
    code = np.asarray(coded.indices, dtype=np.int64)
    first = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(first, code, order)
    return code, first


def _place_order(no_id: np.ndarray, own: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rank of each place; equal places (repeated rows) rank alike."""
    by = np.lexsort((start, key, own, no_id))
    new = np.zeros(len(by), np.int64)
    for x in (no_id, own, key, start):
        new[1:] |= x[by][1:] != x[by][:-1]
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(new)
    return rank


def _regions(shared, length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = shared.value
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                data, ends = utf8_bytes(part.column("text"))
                runs = Runs(data, ends, length, q)
                some = np.flatnonzero(keep.probe(runs.bucket))
                if not len(some):
                    continue
                low, row, bucket = runs.low[some], runs.row[some], runs.bucket[some].view(np.int64)
                size = runs.high[some] - low + length
                regions = _gather(data, low, size)
                start = low - ends[row]
                no_id, own, key = (np.asarray(part.column(c).take(pa.array(row))) if c != "__no_id" else
                                   np.asarray(part.column(c).take(pa.array(row)).cast(pa.int8()))
                                   for c in ("__no_id", "__id", "__key"))
                order = _place_order(no_id, own, key, start)
                code, first = _first_of_equal(regions, order)
                later = order != first[code]
                # one row for the first of equal regions, spans for the others
                lead = np.unique(np.where(later, -1, code), return_index=True)
                stay = lead[1][lead[0] >= 0]
                yield _region_rows(bucket[stay], bucket[stay], regions.take(pa.array(stay)), no_id[stay], own[stay],
                                   key[stay], start[stay], start[stay] + size[stay])
                gone = np.flatnonzero(later)
                if len(gone):
                    a, b, r = _merged(row[gone], start[gone], start[gone] + size[gone])
                    look = {int(x): k for k, x in zip(gone[::-1], row[gone][::-1], strict=True)}
                    k = np.array([look[int(x)] for x in r])
                    yield _region_rows(key[k], None, None, no_id[k], own[k], key[k], a, b)

    return run


def _region_rows(deal, bucket, regions, no_id, own, key, start, stop) -> pa.RecordBatch:
    n = len(deal)
    return pa.RecordBatch.from_arrays([
        pa.array(deal, pa.int64()), pa.nulls(n, pa.int64()) if bucket is None else pa.array(bucket, pa.int64()),
        pa.nulls(n, pa.binary()) if regions is None else regions.cast(pa.binary()),
        pa.array(no_id.astype(bool)), pa.array(own, pa.int64()), pa.array(key, pa.int64()),
        pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
        ["deal", "bucket", "region", "__no_id", "__id", "__key", "start", "stop"])


def _merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, row) of the unions of touching intervals, row by row."""
    if not len(row):
        return start, stop, row
    by = np.lexsort((start, row))
    row, start, stop = row[by], start[by], stop[by]
    wide = np.int64(1) << np.int64(40)  # one axis for all rows
    base = np.cumsum(np.diff(row, prepend=row[0]) != 0) * wide
    reach = np.maximum.accumulate(base + stop)
    new = np.concatenate([[True], base[1:] + start[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    end = reach[np.concatenate([first[1:], [len(row)]]) - 1] - base[first]
    return start[first], end, row[first]


def refine(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(place, bucket) of every string of ``length`` bytes inside the texts laid end to end in
    ``data``: two strings are equal just if their bucket numbers are.

    Bucket-pointer refinement: the number of a suffix at depth 2 d is the rank of (its number at
    depth d, the number at depth d of the suffix d bytes on).
    """
    sizes = np.diff(ends)
    room = np.repeat(ends[1:], sizes) - np.arange(len(data))  # bytes to the end of the own text
    place = np.flatnonzero(room >= 8)
    number = np.full(len(data), -1, np.int64)
    grams = _grams8(np.concatenate([data, np.zeros(7, np.uint8)]))
    number[place] = np.unique(grams[place], return_inverse=True)[1]
    depth = 8
    while depth < length:
        step = min(depth, length - depth)
        place = place[room[place] >= depth + step]
        pair = (number[place] << 32) | number[place + step]
        number = np.full(len(data), -1, np.int64)
        number[place] = np.unique(pair, return_inverse=True)[1]
        depth += step
    return place, number[place]


def _resolved(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Spans of the later strings in whole buckets of regions."""
    regions = rows["region"].cast(pa.large_binary()).combine_chunks()
    no_id = np.asarray(rows["__no_id"].cast(pa.int8()), dtype=np.int64)
    bucket, own, key, start, stop = (np.asarray(rows[c], dtype=np.int64) for c in ("bucket", "__id", "__key", "start", "stop"))
    order = _place_order(no_id, own, key, start)
    code, first = _first_of_equal(regions, order)
    later = order != first[code]
    parts = [(np.flatnonzero(later), start[later], stop[later])]
    # one row of each different region, in order of place; buckets with several of them
    lead = np.flatnonzero(~later)
    lead = lead[np.unique(code[lead], return_index=True)[1]]
    several = np.bincount(np.unique(bucket[lead], return_inverse=True)[1])
    lead = lead[several[np.unique(bucket[lead], return_inverse=True)[1]] > 1]
    lead = lead[np.argsort(order[lead], kind="stable")]
    # whole buckets together, a bounded number of bytes at a time
    lead = lead[np.argsort(bucket[lead], kind="stable")]
    total = np.concatenate([[0], np.cumsum((stop - start)[lead])])
    cuts = np.concatenate([np.flatnonzero(np.diff(bucket[lead])) + 1, [len(lead)]])
    at = 0
    while at < len(lead):
        want = min(len(lead), max(at + 1, int(np.searchsorted(total, total[at] + _REFINE_BYTES))))
        to = int(cuts[np.searchsorted(cuts, want)])
        parts.append(_later_strings(regions, lead[at:to], start, length))
        at = to
    row, a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_pydict({"__id": pa.array(own[row]), "__key": pa.array(key[row]),
                                       "start": pa.array(a, pa.int64()), "stop": pa.array(b, pa.int64())})


def _later_strings(regions: pa.LargeBinaryArray, lead: np.ndarray, start: np.ndarray, length: int):
    """(row, start, stop) of runs of strings that are not the first of their bucket."""
    data, ends = _bytes_of(regions.take(pa.array(lead)))
    place, bucket = refine(data, ends, length)
    first = np.unique(bucket, return_index=True)[1]
    later = np.ones(len(place), bool)
    later[first] = False
    place = place[later]
    text = np.searchsorted(ends, place, side="right") - 1
    head = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(text) != 0)])) if len(place) else np.empty(0, np.int64)
    tail = np.concatenate([head[1:], [len(place)]]).astype(np.int64) - 1 if len(place) else head
    row = lead[text[head]]
    a = place[head] - ends[text[head]] + start[row]
    return row, a, place[tail] - ends[text[tail]] + start[row] + length


def _bytes_of(regions: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.frombuffer(regions.buffers()[1], np.int64)[regions.offset:regions.offset + len(regions) + 1]
    return np.frombuffer(regions.buffers()[2], np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def _resolver(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            spans = batch.filter(pc.is_null(batch.column("region")))
            if spans.num_rows:
                yield spans.select(["__id", "__key", "start", "stop"])
            batch = batch.filter(pc.is_valid(batch.column("region")))
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            bucket = np.asarray(batch.column("bucket"))
            change = np.flatnonzero(bucket != bucket[-1])
            if size >= 4 * _REFINE_BYTES and len(change):
                cut = int(change[-1]) + 1  # the last bucket may go on
                held[-1] = batch.slice(0, cut)
                yield _resolved(pa.Table.from_batches(held), length)
                held, size = [batch.slice(cut)], 0
        if held:
            yield _resolved(pa.Table.from_batches(held), length)

    return run


def _namer(length: int):
    """Regions of crowded buckets, string by string: a 128-bit name and the place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                data, ends = _bytes_of(batch.column("region").cast(pa.large_binary()))
                room = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(data))
                place = np.flatnonzero(room >= length)
                text = np.searchsorted(ends, place, side="right") - 1
                start = place - ends[text] + np.asarray(batch.column("start"))[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_names(data, length, seed)[place].view(np.int64)) for seed in (1, 2)]
                    + [batch.column(c).take(pa.array(text)) for c in ("__no_id", "__id", "__key")] + [pa.array(start)],
                    ["name1", "name2", "__no_id", "__id", "__key", "start"])

    return run


def _final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", _CHUNK):
            data, ends = utf8_bytes(part.column("text"))
            spans = part.column("spans")
            sizes = np.asarray(pc.fill_null(pc.list_value_length(spans), 0), dtype=np.int64)
            flat = spans.flatten()
            row = np.repeat(np.arange(part.num_rows), sizes)
            a, b, r = _merged(row, np.asarray(flat.field("start"), dtype=np.int64), np.asarray(flat.field("stop"), dtype=np.int64))
            edge = np.zeros(len(data) + 1, np.int8)
            edge[ends[r] + a] += 1
            edge[ends[r] + b] -= 1
            stays = np.cumsum(edge[:-1], dtype=np.int8) == 0
            left = np.concatenate([[0], np.cumsum(stays)])[ends]
            count = np.searchsorted(r, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
                pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows,
                                                 [None, pa.py_buffer(left), pa.py_buffer(data[stays])]).cast(pa.binary()),
                pa.ListArray.from_arrays(pa.array(count, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["start", "stop"]))],
                ["doc_id", "n_bytes", "kept", "removed"])


def spans_of_documents(spans: DataFrame) -> DataFrame:
    """The distinct spans of each document, however many rows repeat it."""
    return spans.groupBy("__id", "__key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, q: int = Q, filter_bits: int = FILTER_BITS,
                 bucket_regions: int = BUCKET_REGIONS) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text): doc_id, n_bytes, kept (the bytes left, joined),
    removed (array of start and stop of the maximal removed runs).

    Strings are judged on the input. Null ids come last in the order, equal ids by hash of their
    texts; rows that repeat id and text are one document. A null or empty text has no bytes. Texts
    under ``length`` bytes keep all. An empty table gives no rows.
    """
    if not 8 <= q <= length:
        raise ValueError("a q-gram has 8 bytes to the length of a string")
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col("doc_id").isNull().alias("__no_id"), *row_keys(), text_or_empty().alias("text"))
    repeated = repeated_buckets(texts, length, q)
    keep = spark.sparkContext.broadcast(bucket_filter(repeated, filter_bits))
    regions = texts.mapInArrow(_regions(keep, length, q), REGIONS)
    crowded = repeated.filter(F.col("n") > bucket_regions).select("bucket")
    spans = None
    if not crowded.isEmpty():
        regions = materialize(regions, "suffix-regions")
        named = materialize(
            regions.join(crowded, "bucket", "left_semi").select("region", "__no_id", "__id", "__key", "start").mapInArrow(
                _namer(length), "name1 long, name2 long, __no_id boolean, __id long, __key long, start long"), "suffix-named")
        place = F.struct("__no_id", "__id", "__key", "start")
        firsts = materialize(named.groupBy("name1", "name2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                             .filter("first <> last").drop("last"), "suffix-firsts")
        spans = named.join(firsts, ["name1", "name2"]).filter(place != F.col("first")).select(
            "__id", "__key", "start", (F.col("start") + length).alias("stop"))
        regions = regions.join(crowded, "bucket", "left_anti").select(*regions.columns)
    resolved = regions.repartition("deal").sortWithinPartitions("bucket").mapInArrow(_resolver(length), SPANS)
    spans = resolved if spans is None else resolved.unionByName(spans)
    # rows that repeat a document find the same spans: distinct ones, on the map side already
    by_doc = spans_of_documents(spans)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_keys(), text_or_empty().alias("text"))
    return rows.join(by_doc, ["__id", "__key"], "left").select("doc_id", "text", "spans").mapInArrow(
        _final, "doc_id long, n_bytes long, kept binary, removed array<struct<start:long,stop:long>>")


def suffix_dedup_digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return suffix_dedup(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
