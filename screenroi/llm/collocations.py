"""Phrase collocations per language by SON partitioning.

A phrase is 2 to 5 words that stand together inside a piece (no separator between them). SON mines in
two passes over the texts:

1. A shard is what one task holds: at most ``SHARD_WORDS`` words of a language. Each shard is mined
   completely, level by level, at a support lowered to its share of the language's bytes,
   ``ceil(support * own / all)``. A phrase that is frequent in the whole language reaches that in one
   shard at least, since shares add up to one.
2. The union of the locally frequent phrases, less those whose counts so far plus the most that the
   silent shards can hold (one less than their local support each) stay below the support, is counted
   in all texts exactly.

Inside a shard words are numbered, and a phrase of k words is the pair (number of its first k - 1
words, last word), so nothing is compared by hash. The second pass looks phrases up by 64-bit keys,
which only decide what is sent on: sums are taken by the phrase itself, and what a key let through
by chance is below the support or a candidate. Keys are broadcast ``KEYS`` at a time; more candidates
are counted in further rounds, dealt by first word.

Only counts move: the locally frequent phrases of each shard, then the candidates of each shard. The
local support cannot fall below one, so a language of more shards than ``support`` gains nothing from
the first pass; support should grow with the corpus, as SON's share does.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, ship_package, text_or_empty
from screenroi.llm.tokens import slices

SUPPORT, LONGEST, TOP = 100, 5, 2000
#: A phrase goes if a longer candidate around it has this share of its count, in hundredths.
CLOSED_PERCENT = 100
#: Words that a task holds at most before it mines them as a shard, and the bytes of text dealt to a task: fewer,
#: since scan tasks are of uneven size and what is left of one would be a shard of low support.
SHARD_WORDS, SHARD_BYTES = 16_000_000, 64 << 20
#: Candidate keys broadcast at a time (8 bytes each).
KEYS = 4_000_000
UNKNOWN = "und"
_CHUNK = 4 << 20
_WORDS = 500_000
_ROWS = 100_000
_PARTS = 16

_FOLD = bytes(range(256)).translate(bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9))
_FOLD = _FOLD.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


# ---- one shard -----------------------------------------------------------------------------------

def _numbered(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each entry's value, where each value first stands, how often it occurs)."""
    order = np.argsort(code, kind="stable")
    own = code[order]
    new = np.empty(len(own), bool)
    new[:1] = True
    np.not_equal(own[1:], own[:-1], out=new[1:])
    del own
    starts = np.flatnonzero(new)
    name = np.empty(len(order), np.int32)
    name[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return name, order[starts], np.diff(starts, append=len(order)).astype(np.int32)


class Shard:
    """Numbered words of one language, in order of reading.

    ``room[p]`` is how many words from p on belong to the same piece, ``LONGEST`` at most; 0 marks words
    that only follow a cut inside a very long piece and start no phrase here.
    """

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids, self.room = np.empty(0, np.int32), np.empty(0, np.uint8)
        self.held = 0
        self.words = 0
        self.bytes = 0

    def add(self, words: list[bytes], sizes: np.ndarray, ahead: int = 0) -> None:
        """``words`` of pieces with ``sizes`` words each; the last ``ahead`` start nothing."""
        a, b = self.held, self.held + len(words)
        if b > len(self.ids):  # grown in place
            self.ids.resize(b + b // 4, refcheck=False)
            self.room.resize(b + b // 4, refcheck=False)
        self.ids[a:b] = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self.room[a:b] = np.minimum(np.repeat(np.cumsum(sizes), sizes) - np.arange(len(words)), LONGEST)
        self.room[b - ahead:b] = 0
        self.held = b
        self.words += len(words) - ahead

    def _lengthen(self, name: np.ndarray, on: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Renames the phrases of k - 1 words where ``on`` to those of k, -1 elsewhere: pairs of name and last word.
        Returns where each stands first and its count. A share of the names at a time, to save memory."""
        part = np.where(on, name & (_PARTS - 1), _PARTS).astype(np.uint8)
        name[part == _PARTS] = -1
        firsts, counts = [], []
        done = 0
        for share in range(_PARTS):
            own = np.flatnonzero(part == share).astype(np.int32)
            code = name[own].astype(np.int64)
            code *= len(self.number)
            code += self.ids[own + np.int32(k - 1)]
            named, first, count = _numbered(code)
            del code
            named += np.int32(done)
            name[own] = named
            firsts.append(own[first])
            counts.append(count)
            done += len(count)
        return np.concatenate(firsts), np.concatenate(counts)

    def levels(self, keep: Callable[[Callable[[int, int], np.ndarray], np.ndarray], np.ndarray]) -> Iterator[tuple]:
        """(k, words, counts) of the kept phrases of k words, for k from 1 on; ``words(a, b)`` gives phrases a to b as
        rows of word numbers. ``keep`` says from such a function and the counts which phrases are kept; phrases grow
        from kept ones only."""
        ids, room = self.ids[:self.held], self.room[:self.held]
        name, on = ids.copy(), room > 0
        counts = np.bincount(ids[on], minlength=len(self.number)).astype(np.int32)
        first = np.zeros(len(counts), np.int32)
        first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1, dtype=np.int32)
        for k in range(1, LONGEST + 1):
            if k > 1:
                first, counts = self._lengthen(name, on, k)

            def words(a: int, b: int, starts: np.ndarray = first, k: int = k) -> np.ndarray:
                return ids[starts[a:b, None] + np.arange(k, dtype=np.int32)]

            kept = keep(words, counts) & (counts > 0)
            of = np.flatnonzero(kept)
            yield k, lambda a, b, starts=first[of], words=words: words(a, b, starts), counts[of]
            if not len(of):
                return
            on = kept[name]
            on &= name >= 0
            on &= room > k

    def vocabulary(self) -> np.ndarray:
        out = np.empty(len(self.number), dtype=object)
        out[:] = list(self.number)
        return out


def _read(batches: Iterator[pa.RecordBatch], mined: Callable[[str, Shard], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Fills a shard for each language from rows of (lang, text), and hands full and last ones to ``mined``."""
    shards: defaultdict[str, Shard] = defaultdict(Shard)

    def put(lang: str, words: list[bytes], sizes: list[int], size_bytes: int, ahead: int = 0) -> Iterator[pa.RecordBatch]:
        shards[lang].bytes += size_bytes
        if words:
            shards[lang].add(words, np.array(sizes), ahead)
        if shards[lang].words >= SHARD_WORDS:
            yield from mined(lang, shards.pop(lang))

    for batch in batches:
        for part in slices(batch, "text", _CHUNK):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                words: list[bytes] = []
                sizes: list[int] = []
                size_bytes = 0
                for piece in text.encode().translate(_FOLD).split(b"\n"):
                    own = piece.split()
                    left = len(piece) + 1
                    while len(own) > SHARD_WORDS:  # a piece that fills a shard alone is cut; what follows is looked into
                        ahead = min(LONGEST - 1, len(own) - SHARD_WORDS)
                        used = sum(map(len, own[:SHARD_WORDS])) + SHARD_WORDS
                        yield from put(lang, own[:SHARD_WORDS + ahead], [SHARD_WORDS + ahead], used, ahead)
                        own, left = own[SHARD_WORDS:], left - used
                    if own:
                        words += own
                        sizes.append(len(own))
                    size_bytes += left
                    if len(words) >= _WORDS:
                        yield from put(lang, words, sizes, size_bytes)
                        words, sizes, size_bytes = [], [], 0
                yield from put(lang, words, sizes, size_bytes)
            if sum(s.words for s in shards.values()) >= SHARD_WORDS:
                largest = max(shards, key=lambda lang: shards[lang].words)
                yield from mined(largest, shards.pop(largest))
    for lang in list(shards):
        yield from mined(lang, shards.pop(lang))


def _batch(lang: str, phrases: list[bytes], counts: np.ndarray, size: int, least: int) -> pa.RecordBatch:
    n = len(phrases)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array(np.full(n, size, np.int32)),
         pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64)), pa.array(np.full(n, least, np.int64))],
        ["lang", "size", "phrase", "n", "least"])


def _rows(lang: str, vocabulary: np.ndarray, words, counts: np.ndarray, size: int, least: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(counts), _ROWS):
        texts = list(map(b" ".join, vocabulary[words(a, a + _ROWS)].tolist()))
        yield _batch(lang, texts, counts[a:a + _ROWS], size, least)


_ROW = "lang string, size int, phrase string, n long, least long"


def _miner(support: int, lang_bytes: dict[str, int]):
    """First pass: a row for each locally frequent phrase, and one of size 0 for each shard (words, local support)."""
    def mined(lang: str, shard: Shard) -> Iterator[pa.RecordBatch]:
        least = max(1, -(-support * shard.bytes // max(1, lang_bytes.get(lang, 0))))
        if not shard.words:
            return
        yield _batch(lang, [b""], np.array([shard.words]), 0, least)
        vocabulary = shard.vocabulary()
        for k, words, counts in shard.levels(lambda _, counts: counts >= least):
            yield from _rows(lang, vocabulary, words, counts, k, least)

    return lambda batches: _read(batches, mined)


# ---- keys of phrases -------------------------------------------------------------------------------

def _word_keys(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def _mix(parts: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row of words' keys."""
    out = np.zeros(len(parts), np.uint64)
    for k in range(parts.shape[1]):
        out = (out ^ parts[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _phrase_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, key) of each phrase: keys of its first word and of the whole, as longs."""
    for batch in batches:
        first, whole = [], []
        for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
            keys = _word_keys(phrase.encode().split(b" "), lang)
            first.append(keys[0])
            whole.append(_mix(keys[None, :])[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (first, whole)], ["first", "key"])


def _counter(known):
    """Second pass: counts of the phrases whose keys are in the sorted array ``known`` broadcasts."""
    def mined(lang: str, shard: Shard) -> Iterator[pa.RecordBatch]:
        keys = known.value
        if not shard.words:
            return
        vocabulary = shard.vocabulary()
        own = _word_keys(vocabulary.tolist(), lang)

        def keep(words, counts: np.ndarray) -> np.ndarray:
            kept = np.empty(len(counts), bool)
            for a in range(0, len(counts), _ROWS):
                found = _mix(own[words(a, a + _ROWS)]).view(np.int64)
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                kept[a:a + _ROWS] = keys[at] == found
            return kept

        for k, words, counts in shard.levels(keep):
            yield from _rows(lang, vocabulary, words, counts, k, 0)

    return lambda batches: _read(batches, mined)


# ---- the two passes ----------------------------------------------------------------------------------

def frequent_phrases(docs: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """((lang, size, phrase, f) of all phrases of 1 to ``LONGEST`` words with f >= support, (lang, n) with all
    words of each language that can have one). Reads lang and text; null languages are ``und``, null texts empty.

    A language with fewer bytes than ``support`` words take has no frequent phrase; the others, one
    number each, are known to all tasks.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), text_or_empty().alias("text"))
    found = rows.groupBy("lang").agg(F.sum(F.octet_length("text") + 1).alias("bytes")).filter(F.col("bytes") >= 2 * support - 1).collect()
    lang_bytes = {r.lang: r.bytes for r in found}
    total = sum(lang_bytes.values())
    # whole scan tasks are put together until a task has a shard's worth of text; nothing is shuffled
    dealt = rows.filter(F.octet_length("text") > 0).coalesce(max(1, -(-total // SHARD_BYTES), spark.sparkContext.defaultParallelism))
    local = materialize(dealt.mapInArrow(_miner(support, lang_bytes), _ROW), "phrases-local")
    totals = F.broadcast(local.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("words"), F.sum(F.col("least") - 1).alias("silent")))
    candidates = materialize(
        local.filter("size > 0").groupBy("lang", "size", "phrase")
        .agg(F.sum("n").alias("n"), F.sum(F.col("least") - 1).alias("heard")).join(totals, "lang")
        .filter(F.col("n") + F.col("silent") - F.col("heard") >= support).select("lang", "phrase")
        .mapInArrow(_phrase_keys, "first long, key long"), "phrase-keys")
    rounds = max(1, -(-candidates.count() // KEYS))
    counted = None
    for k in range(rounds):
        own = candidates.filter(F.pmod("first", F.lit(rounds)) == k).select("key").distinct().toArrow()["key"]
        known = spark.sparkContext.broadcast(np.sort(np.asarray(own.combine_chunks())) if len(own) else np.zeros(1, np.int64))
        one = materialize(dealt.mapInArrow(_counter(known), _ROW).groupBy("lang", "size", "phrase")
                          .agg(F.sum("n").alias("f")).filter(F.col("f") >= support), "phrases-counted")
        counted = one if counted is None else counted.unionByName(one)
    words = local.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return (counted if rounds == 1 else counted.distinct()), words


# ---- scores ------------------------------------------------------------------------------------------

def _joined(words, start, size):
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, closed_percent: int = CLOSED_PERCENT) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score (numbers long).

    a, l, r: counts of the phrase and of the two parts at its lowest-scoring cut; n: all words of the
    language; score: floor(1000 a n / (l r)) in whole numbers. Phrases with ``100 f(longer) >= closed_percent * a``
    for a longer candidate around them go. Null texts are empty, repeated rows count each time, ties are
    broken by count, then phrase; a very long text is mined piece by piece; a table without words gives no
    rows, and further columns do not matter.
    """
    frequent, totals = frequent_phrases(docs, support)
    phrases = frequent.filter("size > 1").withColumn("words", F.split("phrase", " "))
    size = F.col("size")
    inside = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda start: _joined(F.col("words"), start, m))))
    longer = (phrases.filter("size > 2").select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("around")))
    cuts = phrases.select("lang", "phrase", "words", "size", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("left"),
                       _joined(F.col("words"), F.col("k") + 1, size - F.col("k")).alias("right"))
    parts = frequent.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("left"), F.col("count").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("right"), F.col("count").alias("r")), ["lang", "right"])
    # one row a language
    scored = cuts.join(F.broadcast(totals), "lang").withColumn("score", F.expr(
        "(cast(a as decimal(20,0)) * 1000 * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * F.col("around") < closed_percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
