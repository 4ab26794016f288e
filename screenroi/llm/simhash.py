"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are computed where texts are read. Distinct ones are linked at two or fewer
differing bits with an index of shared masked patterns:

* upper level, dealt by Spark: the 64 bits are four blocks; two fingerprints at distance 2 or less
  agree on at least two blocks. A node is a mask of two blocks and its bit pattern; a fingerprint
  lies under six nodes, so no link is lost. A node of more than ``NODE_LIMIT`` fingerprints is
  divided in the same way by its remaining 32 bits, after which 16 bits are left: no node can hold
  more than 65,536 fingerprints, however many copies there are.
* inside a node: fingerprints sorted by Gray rank, grouped bottom up; each group keeps the bits all
  its members share as (mask, pattern), factored out of its members. A search adds up differences
  from the top and drops a whole group as soon as the sum is over the distance.

A node gives a spanning forest of its links, not all pairs. Components are found by alternating
large-star and small-star steps on those links, tables of (fingerprint, fingerprint).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, row_keys, ship_package, text_or_empty, without
from screenroi.llm.tokens import slices

SHINGLE = 3
DISTANCE = 2
NODE_LIMIT = 1 << 16
FANOUT = 8
QUERY_BLOCK = 4096
_CHUNK = 2 << 20


# ---- fingerprints ------------------------------------------------------------------------------

def _hashes(text: str | None, shingle: int) -> list[int]:
    from xxhash import xxh64_intdigest

    # bytes: lower() changes A-Z only and split() cuts at \x20 and \x09-\x0D only
    words = (text or "").encode().lower().split()
    if not words:
        return []
    parts = zip(*(words[k:] for k in range(shingle)), strict=False) if len(words) > shingle else [words]
    return list(map(xxh64_intdigest, map(b" ".join, parts), repeat(42)))


def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprints; 0 for a text without words."""
    found = [_hashes(t, shingle) for t in texts]
    sizes = np.array([len(h) for h in found])
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    flat = np.array([h for hs in found for h in hs], "<u8")
    bits = np.unpackbits(flat.view(np.uint8), bitorder="little").reshape(-1, 64)
    ends = np.cumsum(sizes[some])
    counts = np.add.reduceat(bits, ends - sizes[some], axis=0, dtype=np.int64)
    over = 2 * counts > sizes[some][:, None]
    out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _fingerprinter(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                prints = fingerprints_of(part.column("text").to_pylist(), shingle).view(np.int64)
                yield part.drop_columns(["text"]).append_column("fp", pa.array(prints))

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, __id, __key, fp (signed long) of every row, written once."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_keys(), text_or_empty().alias("text"))
    return materialize(rows.mapInArrow(_fingerprinter(shingle), "doc_id long, __id long, __key long, fp long"),
                       "simhash-prints")


# ---- index inside a node -----------------------------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of (residual mask, pattern) over codes in Gray order; level 0 is the codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        masks = [np.full(len(codes), 2**64 - 1, np.uint64)]
        self.patterns = [self.codes]
        while len(self.patterns[-1]) > FANOUT:
            value, mask = self.patterns[-1], masks[-1]
            first = np.arange(0, len(value), FANOUT)
            head = np.repeat(value[first], np.diff([*first, len(value)]))
            masks.append(np.bitwise_and.reduceat(mask & ~(value ^ head), first))
            self.patterns.append(value[first] & masks[-1])
        self.residual = [m & ~np.repeat(masks[k + 1], FANOUT)[:len(m)] if k + 1 < len(masks) else m
                         for k, m in enumerate(masks)]

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of index pairs (i < j) of ``codes`` at most ``distance`` bits apart."""
        top = len(self.patterns) - 1
        for a in range(0, len(self.codes), QUERY_BLOCK):
            own = np.arange(a, min(a + QUERY_BLOCK, len(self.codes)))
            n = len(self.patterns[top])
            query, node, sums = np.repeat(own, n), np.tile(np.arange(n), len(own)), 0
            for level in range(top, -1, -1):
                if level < top:
                    query = np.repeat(query, FANOUT)
                    sums = np.repeat(sums, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    there = node < len(self.patterns[level])
                    query, node, sums = query[there], node[there], sums[there]
                # groups that lie wholly before the query were searched from the other side
                later = (node + 1) * FANOUT**level > query
                differ = np.bitwise_count((self.codes[query] ^ self.patterns[level][node]) & self.residual[level][node])
                sums = sums + differ.astype(np.int64)
                near = later & (sums <= distance)
                query, node, sums = query[near], node[near], sums[near]
            pair = node > query
            yield query[pair], node[pair]


class _Forest:
    """Union-find over one node's codes."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def node_links(codes: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct ``codes`` (unsigned), as (code, code)."""
    index = GrayIndex(codes)
    forest = _Forest(len(codes))
    for left, right in index.links(distance):
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            forest.link(i, j)
    roots = [forest.root(i) for i in range(len(codes))]
    own = index.codes.view(np.int64).tolist()
    return [(own[i], own[r]) for i, r in enumerate(roots) if r != i]


def _linker(distance: int):
    def links(keys: np.ndarray, codes: np.ndarray) -> list[tuple[int, int]]:
        """Of rows sorted by node key."""
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sizes = np.diff([*first, len(keys)])
        out: list[tuple[int, int]] = []
        for a, n in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            if n == 2:
                x, y = int(codes[a]), int(codes[a + 1])
                if ((x ^ y) & (2**64 - 1)).bit_count() <= distance:
                    out.append((x, y))
            else:
                out += node_links(codes[a:a + n].view(np.uint64), distance)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.empty((0, 2), np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([np.asarray(batch.column("mask"), dtype=np.int64), np.asarray(batch.column("pattern"))])
            held_keys, held = np.concatenate([held_keys, keys]), np.concatenate([held, np.asarray(batch.column("fp"))])
            # the last node may go on in the next batch
            last = np.flatnonzero((held_keys != held_keys[-1]).any(axis=1))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole:
                yield _edges(links(held_keys[:whole], held[:whole]))
                held_keys, held = held_keys[whole:], held[whole:]
        if len(held):
            yield _edges(links(held_keys, held))

    return run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    flat = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_pydict({"u": pa.array(flat[:, 0]), "v": pa.array(flat[:, 1])})


# ---- links of all fingerprints -----------------------------------------------------------------

def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(blocks: list[int]) -> list[int]:
    return [a | b for a, b in combinations(blocks, 2)]


#: Two of four 16-bit blocks; under each, two of the four bytes that are left.
UPPER = _masks([0xFFFF << (16 * k) for k in range(4)])
LOWER = {m: _masks([0xFF << (8 * k) for k in range(8) if not m >> (8 * k) & 1]) for m in UPPER}


def _under(masks: list[tuple[int, int]]) -> Column:
    """Array of (mask number, pattern) of ``fp``."""
    return F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("pattern"))
                     for k, m in masks])


def links(prints: DataFrame, distance: int = DISTANCE, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(u, v): links that connect all of the distinct ``fp`` of ``prints`` that are within ``distance`` <= 2."""
    if not 0 <= distance <= 2:
        raise ValueError("four blocks, two of them shared, find distances up to 2")
    upper = prints.select("fp", F.explode(_under(list(enumerate(UPPER)))).alias("node")).select("node.*", "fp")
    large = materialize(upper.groupBy("mask", "pattern").agg(F.count("*").alias("n"))
                        .filter(F.col("n") > node_limit).select("mask", "pattern"), "simhash-large")
    marked = upper.join(large.withColumn("large", F.lit(True)), ["mask", "pattern"], "left")
    divided = F.array().cast("array<struct<mask:int,pattern:bigint>>")
    for k, m in enumerate(UPPER):
        # a lower node: the upper pattern and two more bytes
        divided = F.when(F.col("mask") == k, _under([(6 + 6 * k + j, m | low) for j, low in enumerate(LOWER[m])])
                         ).otherwise(divided)
    nodes = marked.select("fp", F.explode(
        F.when(F.col("large"), divided).otherwise(F.array(F.struct("mask", "pattern")))).alias("node")
    ).select("node.*", "fp")
    dealt = nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    return dealt.mapInArrow(_linker(distance), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(v, root): for every end of an edge, the least node it is connected to.

    Large-star and small-star steps alternate until the edges no longer change; each step writes a
    table no larger than the edges, and minima combine before they shuffle.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # large: every larger neighbour of u, small: every smaller one and u, linked to the least node at u
        low = materialize(pairs.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low")),
                          "components-low")
        near = pairs.join(low, "u")
        if large:
            out = near.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        else:
            out = near.select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", F.col("low").alias("v")))
        return materialize(out.filter("u <> v").distinct(), "components-step")

    def mark(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    now = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), "components-edges")
    seen = mark(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = star(star(both, True), False)
        if (new := mark(now)) == seen:
            break
        seen = new
    return now.select(F.col("u").alias("v"), F.col("v").alias("root")).union(
        now.select("v", F.col("v").alias("root")).distinct())


def _grouped(docs: DataFrame, shingle: int, distance: int, node_limit: int) -> tuple[DataFrame, DataFrame]:
    """Prints of all rows, and (fp, root) of the fingerprints that have a link."""
    rows = fingerprints(docs, shingle)
    distinct = materialize(rows.select("fp").distinct(), "simhash-distinct")
    found = components(links(distinct, distance, node_limit))
    return rows, materialize(found.select(F.col("v").alias("fp"), "root"), "simhash-roots")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                  node_limit: int = NODE_LIMIT) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text): doc_id, fingerprint, component_id.

    ``component_id`` is the least doc_id of the documents connected by links, itself included; null
    doc_ids do not count (a component of nulls only has null). Texts without words, null ones
    among them, have fingerprint zero and link like others. Repeated rows are linked to each
    other. An empty table gives no rows.
    """
    rows, roots = _grouped(docs, shingle, distance, node_limit)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp", "left")
    rooted = materialize(least.withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
    ids = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    of_print = materialize(rooted.join(ids, "root").select("fp", "component_id"), "simhash-components")
    return rows.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each component, all columns: the least doc_id (null last, then
    by hash of the text); of fully repeated rows one stays."""
    rows, roots = _grouped(docs, shingle, distance, NODE_LIMIT)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("__id"), F.col("__key"))
    best = rows.groupBy("fp").agg(F.min(rank).alias("best")).join(roots, "fp", "left")
    best = materialize(best.withColumn("root", F.coalesce("root", "fp")), "simhash-best")
    stay = materialize(best.groupBy("root").agg(F.min("best").alias("best")).select("best.__id", "best.__key"), "simhash-stay")
    keys = rows.select("__id", "__key")
    gone = keys.join(stay, ["__id", "__key"], "left_anti").distinct()
    kept = without(docs, gone)
    again = materialize(keys.join(stay, ["__id", "__key"], "left_semi").groupBy("__id", "__key").agg(
        F.count("*").alias("n")).filter("n > 1").select("__id", "__key"), "simhash-again")
    if again.isEmpty():
        return kept
    several = without(docs, again, "left_semi")
    once = several.withColumns({"__once_" + str(k): c for k, c in enumerate(row_keys())}).dropDuplicates(
        ["__once_0", "__once_1"]).select(*docs.columns)
    return without(kept, again).unionByName(once)
