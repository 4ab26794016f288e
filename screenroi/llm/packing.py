"""Best-fit packing of token sequences with a swap-based local search.

Documents become pieces of at most ``capacity`` tokens where they are read (only rows of ids'
digests move, no texts or ids). Pieces are dealt evenly to tasks; a task packs groups of up to
``GROUP_PIECES``: best fit decreasing first, then a local search that takes the emptiest bins
apart. Its steps move a document, exchange one for one, or take one longer document against two
shorter ones of a fuller bin. Every step raises the sum of squared fills, so the search ends, and
bins that become empty are dropped. Bins of any number of documents take part. It stops when the
free room left is less than one bin (no packing of the group is shorter) or when a whole round
over all underfull bins changes nothing.

A group loses less than a bin or two against packing all pieces at once, whatever the input.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import ship_package, text_or_empty
from screenroi.llm.tokens import Encoder, slices, tokenizer_path

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 1 << 17
#: Bytes of text laid out at a time: it is done once a core, beside a heap that the stages of a pipeline have filled.
SLICE_BYTES = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(tokenizer: str, capacity: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, ends = encoder.encode(part.column("text"))
                ids = np.insert(ids, ends[1:], end_id)
                sizes = np.diff(ends) + 1
                yield _pieces(part.column("doc_id"), ids, sizes, capacity)
            pa.default_memory_pool().release_unused()  # Arrow keeps what a worker once took

    return cut


def _pieces(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray, capacity: int) -> pa.RecordBatch:
    """Pieces of texts laid end to end in ``ids``: full ones, but for the first of a text."""
    count = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    head = sizes - (count - 1) * capacity
    start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
    length = np.where(piece == 0, head[doc], capacity)
    at = 4 * (np.repeat(np.cumsum(sizes) - sizes, count) + start)
    data = memoryview(ids.astype("<u4")).cast("B")
    crc = [zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
    return pa.RecordBatch.from_pydict({
        "doc_id": doc_ids.cast(pa.int64()).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
        "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
        "ids_crc32": pa.array(crc, pa.int64())})


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit decreasing: the fullest bin with room takes the next longest piece."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set where some bin has room r
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(k)
        else:
            room, b = capacity, len(bins)
            bins.append([k])
        if room > n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins


class LocalSearch:
    """Raises the sum of squared fills of underfull bins until bins empty.

    Bins are indexed by room; a bit set of a bin holds every length that one or two of its documents
    have together, whatever their number, and that of a room all of its bins' (and, until it is next
    made anew, some of bins that have left).
    """

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths.tolist(), capacity
        self.fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
        self.bins = bins
        self.room = (capacity - self.fill).tolist()
        self.gives = [0] * len(bins)
        self.at: dict[int, dict[int, None]] = {}  # room -> its bins
        self.any: dict[int, int] = {}  # room -> lengths they may give
        for b in range(len(bins)):
            self._enter(b)

    def _enter(self, b: int) -> None:
        room = self.room[b]
        if not 0 < room < self.capacity:
            return
        singles = pairs = 0
        for k in self.bins[b]:
            pairs |= singles << self.lengths[k]
            singles |= 1 << self.lengths[k]
        self.gives[b] = singles | pairs
        self.at.setdefault(room, {})[b] = None
        self.any[room] = self.any.get(room, 0) | self.gives[b]

    def _leave(self, b: int) -> None:
        room = self.room[b]
        if b in self.at.get(room, ()):
            del self.at[room][b]
            if not self.at[room]:
                del self.at[room], self.any[room]

    def _exchange(self, n: int, room: int) -> tuple[int, int] | None:
        """(bin, length it gives) that leaves a bin of this room fullest on taking ``n``."""
        low = max(1, n - room)
        while True:
            found = self.any[room] >> low
            give = low + (found & -found).bit_length() - 1
            if not found or give >= n:
                return None
            for b in self.at[room]:
                if self.gives[b] >> give & 1:
                    return b, give
            self.any[room] = 0
            for b in self.at[room]:
                self.any[room] |= self.gives[b]

    def _step(self, source: int) -> bool:
        """Makes the best change that takes tokens from bin ``source``, which is not in the index; False if there
        is none."""
        items, fill = self.bins[source], self.capacity - self.room[source]
        rooms = sorted(r for r in self.at if r <= self.room[source])  # fuller bins only
        best, chosen = 0, None
        for k in sorted(items, key=lambda i: -self.lengths[i]):
            n = self.lengths[k]
            fits = bisect_left(rooms, n)
            if fits < len(rooms):  # it can simply move
                chosen = (k, next(iter(self.at[rooms[fits]])), 0)
                break
            for room in rooms:
                full = self.capacity - room
                most = min(room, n - 1)
                if most * (full - fill + most) <= best:
                    continue
                found = self._exchange(n, room)
                if found and (gain := (n - found[1]) * (full - fill + n - found[1])) > best:
                    best, chosen = gain, (k, *found)
        if chosen is None:
            return False
        k, target, give = chosen
        self._leave(target)
        given = self._pieces(target, give)
        for b, out, into in ((source, [k], given), (target, given, [k])):
            self.bins[b] = [i for i in self.bins[b] if i not in out] + into
            self.room[b] += sum(self.lengths[i] for i in out) - sum(self.lengths[i] for i in into)
        self._enter(target)
        return True

    def _pieces(self, b: int, give: int) -> list[int]:
        """One document of bin ``b``, or else two, of ``give`` tokens together; none for 0."""
        of: dict[int, int] = {}
        for k in self.bins[b] if give else ():
            n = self.lengths[k]
            if n == give:
                return [k]
            if give - n in of:
                pair = [of[give - n], k]
            of[n] = k
        return pair if give else []

    def run(self) -> list[list[int]]:
        """Rounds over all underfull bins, from the emptiest on. Ends when a whole round changes nothing or the
        free room is less than one bin."""
        free = sum(room * len(bins) for room, bins in self.at.items())
        changed = True
        while changed and free >= self.capacity:
            changed = False
            for source in sorted((b for bins in self.at.values() for b in bins), key=lambda b: (-self.room[b], b)):
                if free < self.capacity:
                    break
                if not 0 < self.room[source] < self.capacity:
                    continue
                self._leave(source)
                while self.bins[source] and self._step(source):
                    changed = True
                if not self.bins[source]:
                    free -= self.capacity
                self._enter(source)
        return [b for b in self.bins if b]


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indexes into ``lengths``, each of at most ``capacity`` in sum."""
    full = np.flatnonzero(lengths == capacity)
    short = np.flatnonzero(lengths < capacity)
    bins = LocalSearch(best_fit(lengths[short], capacity), lengths[short], capacity).run() if len(short) else []
    return [[int(k)] for k in full] + [short[b].tolist() for b in bins]


def _packer(capacity: int):
    def packed(group: pa.Table, first: int) -> tuple[pa.RecordBatch, int]:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")]).combine_chunks()
        lengths = np.asarray(group["length"])
        bins = pack(lengths, capacity)
        order = np.fromiter((k for b in bins for k in b), np.int64, len(lengths))
        sequence = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        offset = begins - np.repeat(begins[np.searchsorted(sequence, np.arange(len(bins)))], [len(b) for b in bins])
        out = group.take(pa.array(order))
        out = out.append_column("sequence_id", pa.array(first + sequence, pa.int64()))
        out = out.append_column("offset", pa.array(offset, pa.int64()))
        return out, first + len(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= GROUP_PIECES:
                table, first = packed(pa.Table.from_batches(held), first)
                held = []
                yield from table.to_batches()
        if held and sum(b.num_rows for b in held):
            table, first = packed(pa.Table.from_batches(held), first)
            yield from table.to_batches()

    return run


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
                   end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A document is its ids and ``end_id``. One of more than ``capacity`` ids is cut into full
    pieces, the first being shorter if need be; others are one piece. Sequences hold at most
    ``capacity`` tokens without gaps. A null or empty text is its end id alone; a null doc_id and
    repeated rows are packed like any other. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        _cutter(tokenizer or tokenizer_path(), capacity, end_id), PIECES)
    # dealt by row number, so that neither a hot id nor a hot length gathers in one task
    dealt = pieces.withColumn("__deal", F.monotonically_increasing_id()).repartition("__deal").drop("__deal")
    return dealt.mapInArrow(_packer(capacity), PIECES + ", sequence_id long, offset long")
