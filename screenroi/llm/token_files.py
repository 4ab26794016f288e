"""Token-id files: fixed-width bit packing with block offsets.

One shard file per range of doc_id. Layout, all little endian:

* blocks of ``BLOCK_IDS`` ids (the last may be shorter), each id in ``bits`` bits, low bit first,
  every block padded to a whole byte;
* footer: block offsets (u64, one more than blocks), document starts (u64, one more than
  documents), doc_ids (i64), null flags of doc_ids (u8);
* tail of fixed size: magic, version, bits, ids per block, number of ids, blocks, documents.

``bits`` is the least width that holds the vocabulary. A reader takes tail and footer, then only
the blocks that a range of ids touches, and unpacks each with numpy.

Texts shuffle once, by range of doc_id, because files are in ascending doc_id order; each task
then encodes and writes its own shard. A task writes under a name of its attempt and renames at
the end, so a retried or duplicated attempt leaves one whole file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, ship_package, text_or_empty
from screenroi.llm.tokens import CHUNK_BYTES, Encoder, slices, tokenizer_path
from screenroi.session import scratch_path

BLOCK_IDS = 1 << 16
END_ID = 2
_TAIL = struct.Struct("<8sIIIQQQ")
_MAGIC = b"BITIDS01"


def id_bits(vocabulary: int) -> int:
    """Least bits that hold the ids 0 to ``vocabulary`` - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, low bit first, padded to a byte."""
    if bits in (8, 16, 32):  # whole bytes: the same layout without the bit matrix
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[:n * bits].reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = spread
    return np.packbits(wide.ravel(), bitorder="little").view("<u4").astype(np.uint32)


class ShardWriter:
    """Writes one shard to a binary stream; holds a block and the document table."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.rest = np.empty(0, np.uint32)
        self.offsets, self.starts, self.doc_ids, self.nulls = [0], [0], [], []

    def add(self, ids: np.ndarray, sizes: np.ndarray, doc_ids: list[int | None]) -> None:
        for n, doc in zip(sizes.tolist(), doc_ids, strict=True):
            self.starts.append(self.starts[-1] + n)
            self.doc_ids.append(0 if doc is None else doc)
            self.nulls.append(doc is None)
        ids = np.concatenate([self.rest, ids])
        full = len(ids) // self.block_ids * self.block_ids
        for a in range(0, full, self.block_ids):
            self._block(ids[a:a + self.block_ids])
        self.rest = ids[full:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        for values, kind in ((self.offsets, "<u8"), (self.starts, "<u8"), (self.doc_ids, "<i8"), (self.nulls, "u1")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(_TAIL.pack(_MAGIC, 1, self.bits, self.block_ids, self.starts[-1],
                                  len(self.offsets) - 1, len(self.doc_ids)))


class ShardReader:
    """Random access to a shard in a seekable binary file."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        file.seek(size - _TAIL.size)
        magic, version, self.bits, self.block_ids, self.n_ids, blocks, docs = _TAIL.unpack(file.read(_TAIL.size))
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token-id shard")
        parts = [("<u8", blocks + 1), ("<u8", docs + 1), ("<i8", docs), ("u1", docs)]
        file.seek(size - _TAIL.size - sum(np.dtype(k).itemsize * n for k, n in parts))
        self.offsets, self.starts, self.doc_ids, self.nulls = (
            np.frombuffer(file.read(np.dtype(k).itemsize * n), k) for k, n in parts)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``; reads only the blocks they lie in."""
        if stop <= start:
            return np.empty(0, np.uint32)
        a, b = start // self.block_ids, (stop - 1) // self.block_ids + 1
        self.file.seek(int(self.offsets[a]))
        data = self.file.read(int(self.offsets[b] - self.offsets[a]))
        base = int(self.offsets[a])
        out = [unpack(data[int(self.offsets[k]) - base:int(self.offsets[k + 1]) - base], self.bits,
                      min(self.block_ids, self.n_ids - k * self.block_ids)) for k in range(a, b)]
        whole = out[0] if len(out) == 1 else np.concatenate(out)
        return whole[start - a * self.block_ids:stop - a * self.block_ids]


def _filesystem(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _shard_name(shard: int) -> str:
    return f"shard-{shard:07d}.ids"


def _writer(root: str, tokenizer: str, end_id: int, block_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        encoder = Encoder.of(tokenizer)
        system, folder = _filesystem(root)
        system.create_dir(folder, recursive=True)
        own = f"{folder}/_attempt-{shard}-{context.taskAttemptId()}"
        writer = sink = None
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                if writer is None:
                    sink = system.open_output_stream(own)
                    writer = ShardWriter(sink, id_bits(encoder.tok.get_vocab_size()), block_ids)
                ids, ends = encoder.encode(part.column("text"))
                writer.add(np.insert(ids, ends[1:], end_id), np.diff(ends) + 1, part.column("doc_id").to_pylist())
        if writer is not None:
            writer.close()
            sink.close()
            system.move(own, f"{folder}/{_shard_name(shard)}")
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()), "n_docs": pa.array([len(writer.doc_ids)], pa.int64()),
                "n_ids": pa.array([writer.starts[-1]], pa.int64())})

    return write


def write_token_files(docs: DataFrame, root: str, tokenizer: str | None = None, end_id: int = END_ID,
                      block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write shards under ``root`` in ascending doc_id order.

    Returns the manifest (shard, n_docs, n_ids), one row per shard file, already written. A null
    text is an empty one: the end id alone. Null doc_ids come first; equal ones in order of their
    texts' hash; rows that repeat both in any order, and they divide over shards like others. Very long
    texts are encoded whole. An empty table writes no shard.
    """
    ship_package(docs.sparkSession)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
               .withColumns({"__tie": F.xxhash64("text"), "__copy": F.monotonically_increasing_id()})
               .repartitionByRange("doc_id", "__tie", "__copy").sortWithinPartitions("doc_id", "__tie")
               .drop("__tie", "__copy"))
    return materialize(
        ordered.mapInArrow(_writer(root, tokenizer or tokenizer_path(), end_id, block_ids),
                           "shard long, n_docs long, n_ids long"), "token-manifest")


def _reader(root: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _filesystem(root)
        for batch in batches:
            for shard, base in zip(*(batch.column(c).to_pylist() for c in ("shard", "base")), strict=True):
                with system.open_input_file(f"{folder}/{_shard_name(shard)}") as file:
                    yield from _digests(ShardReader(file), base)

    return read


def _digests(shard: ShardReader, base: int, most_ids: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of one shard, about ``most_ids`` ids in memory at a time."""
    starts, a = shard.starts.astype(np.int64), 0
    while a < len(shard.doc_ids):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + most_ids, side="right")) - 1)
        ids = memoryview(shard.ids(int(starts[a]), int(starts[b])).astype("<u4")).cast("B")
        at = 4 * (starts[a:b + 1] - starts[a])
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(shard.doc_ids[a:b], pa.int64(), mask=shard.nulls[a:b].astype(bool)),
            "start": pa.array(base + starts[a:b], pa.int64()),
            "n_tokens": pa.array(np.diff(starts[a:b + 1]), pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(ids[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)], pa.int64())})
        a = b


def read_token_files(manifest: DataFrame, root: str) -> DataFrame:
    """Per document of the shards under ``root``: doc_id, start, n_tokens, ids_crc32.

    The running sum of shard sizes is over the manifest, one row per file of many documents. The
    files are listed by Spark and dealt to tasks by their size.
    """
    spark = manifest.sparkSession
    ship_package(spark)
    base = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = manifest.select("shard", F.coalesce(base, F.lit(0)).cast("long").alias("base"))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.ids").load(root)
             .select(F.regexp_extract("path", r"shard-(\d+)\.ids$", 1).cast("long").alias("shard")))
    return files.join(F.broadcast(bases), "shard").mapInArrow(
        _reader(root), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to token files in the shared scratch folder and read every file back."""
    root = scratch_path(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, root, tokenizer)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(manifest, root)
