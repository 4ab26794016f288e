"""SON mining against a direct count: shards, cuts, ties, odd rows; the local supports lose nothing."""

import collections
import re
from fractions import Fraction

import pyarrow as pa
import pytest

from screenroi.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, support, top=2000):
    """rows of (lang, text) -> result rows."""
    words, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            own = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(own)
            for k in range(1, 6):
                for i in range(len(own) - k + 1):
                    counts[lang][tuple(own[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if a >= support and len(p) > 1}
        rows = []
        for p, a in found.items():
            cuts = [(1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            around = [b for q, b in found.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= 100 * a for b in around):
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return sorted(out)


def texts():
    return [
        ("en", "New York is big. New York is old! new york, New  York\tis"), ("en", "the the the the the the"),
        ("en", None), ("en", ""), (None, "one two; one two"), ("de", "der Hund, der Hund. DER hund\x0bder hund"),
        ("en", "a b a b a b a b\x0cc d e f g"), ("es", "ñandú é ñandú é ñandú é"), ("en", " \t .,;"), (None, "ÀB àb ÀB"),
        ("en", "c d e f g h"), ("en", "c d e f g h"), ("en", "c d e f g h"),
    ] * 2


@pytest.mark.parametrize("support, shard", [(2, 8_000_000), (3, 7), (2, 3), (4, 1)])
def test_equals_direct_count(spark, monkeypatch, support, shard):
    monkeypatch.setattr(c, "SHARD_WORDS", shard)
    rows = texts()
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], SCHEMA).repartition(5)
    assert sorted(map(tuple, c.collocations(docs, support=support).collect())) == brute(rows, support)


def test_rounds_of_candidates_and_top(spark, monkeypatch):
    monkeypatch.setattr(c, "KEYS", 2)
    rows = texts()
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], SCHEMA)
    assert sorted(map(tuple, c.collocations(docs, support=3, top=2).collect())) == brute(rows, 3, 2)


def mined(rows, support, monkeypatch, shard):
    """What the first pass reports of one task's rows."""
    monkeypatch.setattr(c, "SHARD_WORDS", shard)
    total = collections.Counter()
    for lang, text in rows:
        total[lang] += len(text.encode()) + 1
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    return [r for b in c._miner(support, dict(total))(iter([batch])) for r in b.to_pylist()], total


@pytest.mark.parametrize("shard", [1, 2, 5, 9, 10_000])
def test_every_frequent_phrase_is_frequent_in_a_shard(monkeypatch, shard):
    """A very long piece is cut; shares of bytes never exceed one, counts never exceed the true ones."""
    rows = [("en", "a b c " * 40), ("en", "x y. " * 30 + "z " * 30), ("de", "a b " * 9)]
    found, total = mined(rows, 12, monkeypatch, shard)
    true = collections.defaultdict(collections.Counter)
    words = collections.Counter()
    for lang, text in rows:
        for piece in text.split("."):
            own = piece.split()
            words[lang] += len(own)
            for k in range(1, 6):
                for i in range(len(own) - k + 1):
                    true[lang][" ".join(own[i:i + k])] += 1
    local = collections.defaultdict(collections.Counter)
    for r in found:
        if r["size"]:
            local[r["lang"]][r["phrase"]] += r["n"]
    for lang in true:
        assert sum(r["n"] for r in found if r["lang"] == lang and not r["size"]) == words[lang]
        shards = [r["least"] for r in found if r["lang"] == lang and not r["size"]]
        assert sum(Fraction(x - 1, 1) for x in shards) < 12
        for phrase, n in true[lang].items():
            assert local[lang][phrase] <= n
            if n >= 12:
                assert local[lang][phrase] > 0, (lang, phrase)


def test_odd_rows_and_empty(spark, odd, empty):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert sorted(map(tuple, c.collocations(odd, support=8).collect())) == brute(rows, 8)
    none = c.collocations(empty)
    assert none.count() == 0 and none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, n, left, right = 10 ** 12 + 7, 10 ** 14 + 3, 10 ** 13 + 1, 10 ** 12 + 9
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(n).alias("n"), F.lit(left).alias("l"), F.lit(right).alias("r")).selectExpr(
        "(cast(a as decimal(20,0)) * 1000 * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS s")
    assert row.first().s == 1000 * a * n // (left * right)
