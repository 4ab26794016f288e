"""Embedding whitening from bit-sliced cross-products.

Entries become whole numbers, ``x = floor(256 c)``. For the covariance a block of vectors is turned on
its side: each dimension's entries, less the block's least one, are cut into bit planes, and a plane's
bits of 64 vectors make one word. The product of two dimensions summed over the block is then
``sum 2^(a + b) popcount(plane a AND plane b)``, exactly, and undoing the shifts is whole-number
arithmetic too. A task returns one row of sums for each pair of dimensions, whatever its rows; Spark adds
them as 38-digit decimals. The driver centres them as integers, ``n sum(x y) - sum(x) sum(y)``, before
anything is rounded, and takes the eigenvectors of that matrix (``d (d + 1) / 2`` numbers).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, ship_package

SCALE = 256
COMPONENTS = 4
#: Vectors sliced at a time; a multiple of 64.
BLOCK = 8192
#: Entries are taken no further than this from 0, so that they are whole numbers of a long.
_MOST = float(1 << 62)


# ---- whole-number vectors ------------------------------------------------------------------------

def whole_vectors(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, x): rows whose vector is not null and has only finite entries, entries as floor(256 c).

    Vectors have the length that most of these rows have (of equally many, the longest); rows of another
    length, and empty vectors, go.
    """
    entry = F.col("__v")
    rows = embeddings.select(F.col(key), F.col(vector).cast("array<double>").alias("__v")).filter(
        entry.isNotNull() & (F.size(entry) > 0)
        & ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    lengths = rows.groupBy(F.size(entry).alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("length")).limit(1).collect()
    length = common[0].length if common else 0
    whole = F.transform(entry, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(_MOST)), F.lit(-_MOST))))
    return rows.filter(F.size(entry) == length).select(F.col(key), whole.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of longs, all of one length."""
    flat = np.asarray(pc.list_flatten(column), dtype=np.int64)
    return flat.reshape(len(column), -1)


# ---- bit-sliced sums -----------------------------------------------------------------------------

def cross_sums(x: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(sum of each column, sums of products of column pairs) of a block of longs, as Python integers."""
    rows, width = x.shape
    least = x.min(axis=0)
    shifted = (x - least).astype(np.uint64) if rows else x.astype(np.uint64)
    bits = [int(m).bit_length() for m in shifted.max(axis=0)]
    padded = np.zeros((-(-rows // 64) * 64, width), np.uint64)
    padded[:rows] = shifted
    planes = np.empty((sum(bits), len(padded) // 64), np.uint64)
    owner, weight = [], []
    k = 0
    for j in range(width):
        for b in range(bits[j]):
            on = ((padded[:, j] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            planes[k] = np.packbits(on, bitorder="little").view(np.uint64)
            owner.append(j)
            weight.append(b)
            k += 1
    owner = np.array(owner, np.int64)
    # whole numbers that fit a long where they can, Python's own beyond
    small = 2 * max(bits, default=0) + rows.bit_length() < 60
    kind = np.int64 if small else object
    power = np.array([1 << b for b in weight], dtype=kind)
    products = np.zeros((width, width), dtype=kind)
    sums = np.zeros(width, dtype=kind)
    if k:
        np.add.at(sums, owner, np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind) * power)
    for p in range(k):
        both = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64).astype(kind) * power[p:]
        row = np.zeros(width, dtype=kind)
        np.add.at(row, owner[p:], both)
        i = owner[p]
        # planes behind p stand for pairs of i with itself twice
        row[i] = 2 * row[i] - both[0]
        products[i] += row * power[p]
    low = [int(v) for v in least]
    u = [int(v) for v in sums]
    out = np.empty((width, width), dtype=object)
    for i in range(width):
        for j in range(i, width):
            out[i, j] = int(products[i, j]) + low[i] * u[j] + low[j] * u[i] + rows * low[i] * low[j]
    return [u[j] + rows * low[j] for j in range(width)], out


def _slicer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, j, value) for i <= j: sums of products; (-1, j, value): sums; (-1, -1, value): vectors. One task's rows."""
    n, sums, products = 0, None, None
    held: list[np.ndarray] = []

    def take(x: np.ndarray) -> None:
        nonlocal n, sums, products
        for a in range(0, len(x), BLOCK):
            own, both = cross_sums(x[a:a + BLOCK])
            n += len(x[a:a + BLOCK])
            sums = own if sums is None else [s + t for s, t in zip(sums, own, strict=True)]
            upper = np.triu_indices(len(own))
            products = both[upper] if products is None else products + both[upper]

    for batch in batches:
        if batch.num_rows:
            held.append(_matrix(batch.column("x")))
        if sum(map(len, held)) >= BLOCK:
            take(np.concatenate(held))
            held = []
    if held:
        take(np.concatenate(held))
    if n:
        width = len(sums)
        first, second = np.triu_indices(width)
        i = [-1] * (1 + width) + first.tolist()
        j = [-1, *range(width)] + second.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
             pa.array([str(v) for v in [n, *sums, *products.tolist()]], pa.string())], ["i", "j", "value"])


@dataclass
class Whitening:
    """n vectors with sums S, unit eigenvectors (rows) by falling eigenvalue, eigenvalues, trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def scales(self) -> np.ndarray:
        """1 / sqrt(e); NaN for a component without variance (to rounding)."""
        least = max(self.trace, 0.0) * len(self.sums) * np.finfo(float).eps
        return np.array([1 / np.sqrt(e) if e > least else np.nan for e in self.eigenvalues])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S exactly: longs where they fit, else Python integers."""
        largest = max([int(np.abs(x).max(initial=0)), *(abs(s) // max(self.n, 1) + 1 for s in self.sums)])
        if 2 * self.n * largest < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.components.T * self.scales()


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From the distinct vectors ``x`` of a table; None if it has no rows."""
    parts = vectors.select("x").mapInArrow(_slicer, "i int, j int, value string")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("string").alias("value")).collect()
    found = {(r.i, r.j): int(r.value) for r in rows}
    if not found:
        return None
    n = found[-1, -1]
    width = sum(1 for i, j in found if i == -1 and j >= 0)
    sums = [found[-1, j] for j in range(width)]
    covariance = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            covariance[i, j] = covariance[j, i] = (n * found[i, j] - sums[i] * sums[j]) / (n * n)
    values, vectors_ = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    return Whitening(n, sums, vectors_[:, order].T.copy(), values[order], float(np.trace(covariance)))


# ---- results ---------------------------------------------------------------------------------------

def _error_sums(model: Whitening):
    """(a, b, value): sums of whitened products over a task's rows, (a, -1, value): sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(model.centred(_matrix(batch.column("x"))))
                sums += w.sum(axis=0)
                products += w.T @ w
        a, b = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*a, *range(k)], pa.int32()), pa.array([*b, *[-1] * k], pa.int32()),
             pa.array([*products.ravel(), *sums], pa.float64())], ["a", "b", "value"])

    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over components that
    have variance; None if none has."""
    on = np.isfinite(model.scales())
    if not on.any():
        return None
    rows = vectors.select("x").mapInArrow(_error_sums(model), "a int, b int, value double").groupBy("a", "b").agg(
        F.sum("value").alias("value")).collect()
    found = {(r.a, r.b): r.value / model.n for r in rows}
    k = range(len(on))
    return max(abs(found[a, b] - found[a, -1] * found[b, -1] - (a == b)) for a in k for b in k if on[a] and on[b])


def _projector(model: Whitening, error: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        explained = model.eigenvalues / model.trace if model.trace > 0 else np.full(k, np.nan)
        for batch in batches:
            if not batch.num_rows:
                continue
            centred = model.centred(_matrix(batch.column("x")))
            if centred.dtype != object and len(model.sums) * float(np.abs(centred).max()) ** 2 > 2.0 ** 62:
                centred = centred.astype(object)
            white = model.whitened(centred)
            far = (centred * centred).sum(axis=1).tolist()
            far = [v if v < 1 << 63 else None for v in far]  # beyond a long: null
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)),
                pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(white.ravel(), from_pandas=True), pa.array(np.tile(explained, rows), from_pandas=True),
                pa.array([error] * (rows * k), pa.float64())],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """For each row with a whole vector and each of the first ``components`` components: key, component (from 1),
    n, deviation (sum over dimensions of (n x - S)^2; null where a long cannot hold it), whitened, explained, identity_error.

    Means and covariance are those of the distinct vectors, so copies weigh nothing, but every row has its
    results, repeated keys too. Null vectors, vectors with null or non-finite entries, empty ones and ones of
    another length than the most go (:func:`whole_vectors`). A component without variance has null whitened
    values; where nothing varies explained is null as well. An empty table gives no rows.
    """
    ship_package(embeddings.sparkSession)
    rows = whole_vectors(embeddings, vector, key)
    # copies meet on the map side first: a vector in a third of all rows is one row a task
    distinct = materialize(rows.select("x").distinct(), "whitening-vectors")
    model = fit(distinct, components)
    name = rows.schema[key].dataType.simpleString()
    schema = f"key {name}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    error = identity_error(distinct, model)
    out = rows.withColumnRenamed(key, "key").mapInArrow(_projector(model, error), schema)
    return out.withColumnRenamed("key", key)
