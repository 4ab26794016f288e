"""Toxicity scores by a factorization machine over hashed terms.

Terms of a document are its words and their beginnings of 3 to 6 letters, and a band of its
length, hashed to ``BUCKETS``. The machine has a weight and a short vector per term, so that it
learns pairs (an insult together with a group's name, a stem in a short text) that additive
weights miss:  z = w0 + sum w x + sum over pairs <v, v'> x x'.

Learning takes a bounded sample of labelled rows (``TRAIN_ROWS`` distinct texts, by hash of
doc_id). Spark counts every hashed term of the sample by label. The machine gets the terms that tell
the labels apart alone, and the words that do so only together with another term: words that are
neutral alone are screened by the likelihood ratio of each pair's table of counts against additive
log odds. The sample reduced to these terms is at most ``TRAIN_ROWS`` short rows, on which the driver
fits. Scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, ship_package, text_or_empty
from screenroi.llm.tokens import slices

TRAIN_ROWS = 24_000
BUCKETS = 1 << 21
#: Terms kept for the machine: the most telling, with at least this likelihood-ratio statistic.
TERMS, LEAST_G2 = 4096, 11.0
#: Pairs are looked for among the words whose presence varies most and the first of the telling words. A word
#: joins the machine if its interaction with another term has at least this statistic (some 3 million pairs are
#: looked at; chance gives one above 28), the strongest first. Of words that interact best with the same term (say,
#: all common words of the language in which it is an insult) a few stand for all.
SCREEN_WORDS, SCREEN_TELLING = 2048, 512
PAIR_WORDS, PER_PARTNER, LEAST_INTERACTION = 256, 4, 40.0
FITTING_STEPS = 20
PREFIXES = range(3, 7)
FACTORS = 8
EPOCHS, RATE, DECAY = 150, 0.05, 1e-3
CACHE_WORDS = 500_000
_CHUNK = 8 << 20


# ---- terms -------------------------------------------------------------------------------------

def _bucket(term: str) -> int:
    """Whole words have odd buckets, other terms even ones."""
    return zlib.crc32(term.encode()) % (BUCKETS // 2) * 2 + term.startswith("w:")


def word_buckets(word: str) -> list[int]:
    """Distinct buckets of a lower-case word's terms; punctuation around it does not count."""
    core = word.strip(string.punctuation)
    if not core:
        return []
    return list({_bucket("w:" + core), *(_bucket("p:" + core[:k]) for k in PREFIXES if len(core) >= k)})


def length_bucket(words: int) -> int:
    return _bucket(f"n:{words.bit_length()}")


class TermCounter:
    """Counts of terms per text; ``number`` maps a bucket to the machine's term or None to skip it."""

    def __init__(self, number: Callable[[int], int | None]):
        self.number = number
        self.known: dict[str, list[int]] = {}

    def _numbers(self, buckets: list[int]) -> list[int]:
        return [n for n in map(self.number, buckets) if n is not None]

    def _word(self, word: str) -> list[int]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            found = self.known[word] = self._numbers(word_buckets(word))
        return found

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, count), sorted by row and term."""
        lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        ends = np.asarray(lists.offsets, dtype=np.int64)
        ends = ends - ends[0]
        words = lists.flatten().dictionary_encode()
        own = [self._word(w) for w in words.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter(chain.from_iterable(own), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        code = np.asarray(words.indices, dtype=np.int64)
        some = np.flatnonzero(sizes[code]) if len(code) else np.empty(0, np.int64)
        row = np.searchsorted(ends, some, side="right") - 1
        n = sizes[code[some]]
        at = np.repeat(starts[code[some]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        rows, terms = np.repeat(row, n), flat[at]
        bands = [self._numbers([length_bucket(int(k))]) for k in np.diff(ends)]
        band_rows = np.repeat(np.arange(len(bands)), [len(b) for b in bands])
        keys = np.concatenate([rows, band_rows]) * BUCKETS + np.concatenate(
            [terms, np.fromiter(chain.from_iterable(bands), np.int64)])
        keys, count = np.unique(keys, return_counts=True)
        return keys // BUCKETS, keys % BUCKETS, count


# ---- the machine -------------------------------------------------------------------------------

class FactorizationMachine:
    def __init__(self, buckets: list[int], bias: float):
        rng = np.random.default_rng(5)
        self.number = {b: k for k, b in enumerate(buckets)}
        self.w0 = bias
        self.w = np.zeros(len(buckets))
        self.v = rng.normal(0, 0.05, (len(buckets), FACTORS))

    @staticmethod
    def _value(count: np.ndarray) -> np.ndarray:
        return np.log2(1.0 + count)

    def margins(self, n: int, row: np.ndarray, term: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """z of rows 0 to n - 1, and the rows' sums of v x."""
        sums = np.empty((n, FACTORS))
        pairs = np.zeros(n)
        for f in range(FACTORS):  # one factor at a time: the memory of one column of values
            vx = self.v[:, f][term] * x
            sums[:, f] = np.bincount(row, vx, n)
            pairs += sums[:, f] ** 2 - np.bincount(row, vx * vx, n)
        return self.w0 + np.bincount(row, self.w[term] * x, n) + 0.5 * pairs, sums

    def fit(self, labels: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> None:
        """Full-batch Adam on the log loss with weight decay; the same result on every run."""
        x, n = self._value(count), len(labels)
        state = [np.zeros(2), np.zeros((2, *self.w.shape)), np.zeros((2, *self.v.shape))]
        for step in range(1, EPOCHS + 1):
            z, sums = self.margins(n, row, term, x)
            error = (_sigmoid(z) - labels) / n
            each = error[row] * x
            g_w = np.bincount(term, each, len(self.w)) + DECAY * self.w
            g_v = np.empty_like(self.v)
            for f in range(FACTORS):
                g_v[:, f] = np.bincount(term, each * (sums[:, f][row] - self.v[:, f][term] * x), len(self.w))
            g_v += DECAY * self.v
            for k, (name, g) in enumerate((("w0", error.sum()), ("w", g_w), ("v", g_v))):
                s = state[k]
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.999 * s[1] + 0.001 * g * g
                move = RATE * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-8)
                setattr(self, name, getattr(self, name) - move)

    def scores(self, texts: pa.Array, counter: TermCounter) -> np.ndarray:
        row, term, count = counter.counts(texts)
        return _sigmoid(self.margins(len(texts), row, term, self._value(count))[0])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


# ---- learning ----------------------------------------------------------------------------------

def held_out():
    """crc32 of doc_id as text, mod 5, is 0; rows without an id are held out too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, text) of at most ``most`` labelled rows that are not held out, written once.
    A document with several labels is toxic if one says so; rows that repeat id and text are one row."""
    ids = labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = materialize(ids.orderBy(*order).limit(most), "toxicity-sample")
    # at most `most` rows of two numbers; repeats collapse before they shuffle
    texts = materialize(
        docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id")
        .withColumn("key", F.xxhash64("text")).groupBy("doc_id", "key")
        .agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")), "toxicity-texts")
    if texts.count() <= most:
        return texts.drop("key")
    # ids with many different texts: the bound is on rows
    chosen = materialize(texts.select("doc_id", "key").orderBy(*order, "key").limit(most), "toxicity-chosen")
    return materialize(texts.join(F.broadcast(chosen), ["doc_id", "key"], "left_semi").drop("key"), "toxicity-training")


def _term_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = TermCounter(lambda bucket: bucket)
    for batch in batches:
        for part in slices(batch, "text", _CHUNK):
            row, term, _ = counter.counts(part.column("text"))
            toxic = np.asarray(part.column("toxic"), dtype=np.int64)[row]
            terms, code = np.unique(term, return_inverse=True)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(terms), "n": pa.array(np.bincount(code, minlength=len(terms)), pa.int64()),
                "pos": pa.array(np.bincount(code, toxic, len(terms)).astype(np.int64), pa.int64())})


def _g2(n: float, pos: float):
    """Likelihood-ratio statistic of the 2 x 2 table of term and label."""
    out = F.lit(0.0)
    present, toxic = F.col("n"), F.col("pos")
    for cell, rows, columns in (
        (toxic, present, F.lit(pos)), (present - toxic, present, F.lit(n - pos)),
        (F.lit(pos) - toxic, F.lit(n) - present, F.lit(pos)),
        (F.lit(n) - present - F.lit(pos) + toxic, F.lit(n) - present, F.lit(n - pos)),
    ):
        out = out + F.when(cell > 0, 2 * cell * F.log(cell * F.lit(n) / (rows * columns))).otherwise(0.0)
    return out


def _reducer(number: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(number.get)
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                row, term, count = counter.counts(part.column("text"))
                bounds = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic").cast(pa.int64()),
                     pa.ListArray.from_arrays(bounds, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(bounds, pa.array(count, pa.int32()))], ["doc_id", "toxic", "terms", "counts"])

    return run


def _information(n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Log likelihood of the labels of n rows, pos of them toxic, under their own share."""
    def part(k):
        return k * np.log(np.where(k > 0, k, 1.0) / np.where(n > 0, n, 1.0))

    return part(pos) + part(n - pos)


def three_way(table: np.ndarray) -> np.ndarray:
    """Likelihood-ratio statistic of the interaction in tables (2, 2, 2, k) of term, term and label:
    the counts against those that proportional fitting gives without it, that is against additive
    log odds."""
    fitted = np.full(table.shape, table.sum((0, 1, 2)) / 8)
    for _ in range(FITTING_STEPS):
        for axis in range(3):
            margin = fitted.sum(axis, keepdims=True)
            fitted *= table.sum(axis, keepdims=True) / np.where(margin > 0, margin, 1.0)
    some = table > 0
    return 2 * (table * np.log(np.where(some, table, 1.0) / np.where(some, np.maximum(fitted, 1e-12), 1.0))).sum((0, 1, 2))


def interactions(labels: np.ndarray, row: np.ndarray, term: np.ndarray, size: int,
                 rows: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``size`` terms the strongest interaction (:func:`three_way`) with another one, and
    that one; 0 where none reaches ``LEAST_INTERACTION``. ``row`` is ascending. Counts of pairs are exact
    (under 2**24); only pairs that tell the labels apart better than each of their terms are fitted."""
    both, toxic = np.zeros((size, size), np.float32), np.zeros((size, size), np.float32)
    for a in range(0, len(labels), rows):
        lo, hi = np.searchsorted(row, (a, a + rows))
        x = np.zeros((min(rows, len(labels) - a), size), np.float32)
        x[row[lo:hi] - a, term[lo:hi]] = 1
        both += x.T @ x
        x_toxic = x[labels[a:a + rows] == 1]
        toxic += x_toxic.T @ x_toxic
    total, positive = float(len(labels)), float(labels.sum())
    n, pos = np.diag(both).astype(float), np.diag(toxic).astype(float)
    alone = _information(n, pos) + _information(total - n, positive - pos)
    best, partner = np.zeros(size), np.zeros(size, np.int64)
    for k in range(size - 1):
        later = np.arange(k + 1, size)
        cells = {(1, 1): (both[k, later].astype(float), toxic[k, later].astype(float))}
        cells[1, 0] = n[k] - cells[1, 1][0], pos[k] - cells[1, 1][1]
        cells[0, 1] = n[later] - cells[1, 1][0], pos[later] - cells[1, 1][1]
        cells[0, 0] = total - n[k] - cells[0, 1][0], positive - pos[k] - cells[0, 1][1]
        joint = sum(_information(*cell) for cell in cells.values())
        some = np.flatnonzero(2 * (joint - np.maximum(alone[k], alone[later])) >= LEAST_INTERACTION)
        if not len(some):
            continue
        table = np.empty((2, 2, 2, len(some)))
        for (i, j), (m, p) in cells.items():
            table[i, j, 1], table[i, j, 0] = p[some], m[some] - p[some]
        found = three_way(table)
        found[found < LEAST_INTERACTION] = 0
        if found.max() > best[k]:
            best[k], partner[k] = found.max(), later[some[found.argmax()]]
        better = found > best[later[some]]
        best[later[some[better]]], partner[later[some[better]]] = found[better], k
    return best, partner


def _in_pairs(labels: np.ndarray, row: np.ndarray, term: np.ndarray, telling: np.ndarray, screened: np.ndarray) -> np.ndarray:
    """The ``screened`` terms that a pair with one another or with a ``telling`` term makes telling."""
    looked = np.concatenate([telling, screened])
    place = np.full(int(max(looked.max(initial=0), term.max(initial=0))) + 1, -1)
    place[looked] = np.arange(len(looked))
    own = place[term] >= 0
    best, partner = (found[len(telling):] for found in interactions(labels, row[own], place[term[own]], len(looked)))
    taken: dict[int, int] = {}
    out = []
    for k in np.argsort(-np.round(best, 6), kind="stable"):
        if best[k] < LEAST_INTERACTION or len(out) == PAIR_WORDS:
            break
        taken[partner[k]] = taken.get(partner[k], 0) + 1
        if taken[partner[k]] <= PER_PARTNER:
            out.append(screened[k])
    return np.array(sorted(out), np.int64)


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> FactorizationMachine:
    """Without labelled rows, or without a term that tells them apart, the machine has no terms;
    without labelled rows it scores every text 0.25."""
    ship_package(docs.sparkSession)
    rows = training_rows(docs, labels, most)
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    bias = math.log((pos + 0.5) / (n - pos + 1.5))
    if not 0 < pos < n:
        return FactorizationMachine([], bias)
    stats = materialize(
        rows.select("text", F.col("toxic").cast("long").alias("toxic"))
        .mapInArrow(_term_stats, "bucket long, n long, pos long")
        .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")), "toxicity-terms")
    telling = [r.bucket for r in stats.withColumn("g2", _g2(float(n), float(pos))).filter(F.col("g2") >= LEAST_G2)
               .orderBy(F.desc(F.round("g2", 6)), "bucket").limit(TERMS).collect()]
    known = set(telling)
    varying = stats.filter(F.col("bucket") % 2 == 1).withColumn("spread", F.col("n") * (n - F.col("n"))).filter("spread > 0")
    screened = [r.bucket for r in varying.orderBy(F.desc("spread"), "bucket").limit(SCREEN_WORDS).collect()
                if r.bucket not in known]
    buckets = telling + screened
    if not buckets:
        return FactorizationMachine([], bias)
    # the bounded sample, reduced to these terms
    sample = rows.select("doc_id", F.col("toxic").cast("long").alias("toxic"), "text").mapInArrow(
        _reducer({b: k for k, b in enumerate(buckets)}),
        "doc_id long, toxic long, terms array<int>, counts array<int>").toArrow()
    # rows of one id differ in their texts: the machine sees them in the order of their terms
    sizes = pc.list_value_length(sample["terms"])
    sample = sample.append_column("size", sizes).append_column("sum", _list_sums(sample)).sort_by(
        [(c, "ascending") for c in ("doc_id", "toxic", "size", "sum")]).combine_chunks()
    sizes = np.asarray(sample["size"], dtype=np.int64)
    term = np.asarray(pc.list_flatten(sample["terms"]), dtype=np.int32)
    count = np.asarray(pc.list_flatten(sample["counts"]), dtype=np.int32)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    toxic = np.asarray(sample["toxic"], dtype=float)
    del sample
    # whole words only: a beginning that several languages share interacts with every word of one of them
    telling_words = np.array([k for k, b in enumerate(telling) if b % 2][:SCREEN_TELLING], np.int64)
    pairs = _in_pairs(toxic, row, term, telling_words, np.arange(len(telling), len(buckets)))
    number = np.full(len(buckets), -1)
    number[:len(telling)] = np.arange(len(telling))
    number[pairs] = len(telling) + np.arange(len(pairs))
    machine = FactorizationMachine(telling + [buckets[k] for k in pairs], bias)
    if machine.number:
        own = number[term] >= 0
        machine.fit(toxic, row[own].astype(np.int64), number[term[own]], count[own].astype(np.int64))
    return machine


def _list_sums(sample: pa.Table) -> pa.Array:
    """Per row a number made of its terms and counts, to put rows of one id in a fixed order."""
    sizes = np.asarray(pc.list_value_length(sample["terms"]), dtype=np.int64)
    term = np.asarray(pc.list_flatten(sample["terms"]), dtype=np.float64)
    count = np.asarray(pc.list_flatten(sample["counts"]), dtype=np.float64)
    return pa.array(np.bincount(np.repeat(np.arange(len(sizes)), sizes), (term + 1) * count, len(sizes)))


def _scorer(machine: FactorizationMachine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(machine.number.get)
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(machine.scores(part.column("text"), counter))],
                    ["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text): doc_id, held_out, score, predicted.

    A null text is an empty one; it has the score of a text without known terms. Repeated rows
    score alike. Very long texts are scored whole, a slice of a batch at a time. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_or_empty().alias("text"))
    scored = rows.mapInArrow(_scorer(machine), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Scores of all rows of ``docs`` by a machine that learns from at most ``most`` distinct labelled
    rows; nulls, empty and long texts, repeats and empty tables as in :func:`score` and :func:`train`."""
    return score(docs, train(docs, labels, most))
