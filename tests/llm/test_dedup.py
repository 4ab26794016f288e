"""Exact, line, suffix and SimHash dedup against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenroi.llm.exact_dedup import exact_dedup
from screenroi.llm.line_dedup import line_dedup, line_dedup_digest, without_repeated_lines
from screenroi.llm.simhash import GrayIndex, components, gray_rank, keep_one_of_each, node_links, simhash_dedup
from screenroi.llm.suffix_dedup import refine, suffix_dedup

from . import brute


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# ---- exact

@pytest.mark.parametrize("table", ["documents", "odd"])
def test_exact_dedup(table, request):
    docs = request.getfixturevalue(table)
    got = exact_dedup(docs).collect()
    groups = brute.exact_groups(pairs(docs))
    assert len(got) == docs.count()
    for r in got:
        n, (_, no_id, best) = groups[r.text_sha256]
        assert (r.group_size, r.keep_id) == (n, None if no_id else best)
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted(groups)  # exactly one row of each group
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_saturated_filter(documents):
    """A filter too small to tell anything apart changes nothing in the result."""
    a = sorted(exact_dedup(documents).collect())
    import screenroi.llm.exact_dedup as module

    pages = module.possibly_repeated_filter(
        documents.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")), 1 << 16)
    assert pages.count() <= 2
    many = documents.union(documents.withColumn("doc_id", F.col("doc_id") + 1000000))
    b = {r.doc_id: r for r in exact_dedup(many, filter_bits=1).collect()}
    assert all(b[r.doc_id].group_size == 2 * r.group_size and b[r.doc_id].keep_id == r.keep_id for r in a)


# ---- lines

def test_line_dedup(documents):
    want = brute.line_dedup(sorted(pairs(documents)))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup_digest(documents).collect()}
    assert got == {k: (a, b, brute.sha(c)) for k, (a, b, c) in want.items()}
    assert any(b for _, b, _ in want.values())


def test_line_dedup_odd(odd):
    got = line_dedup(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0]["__n_removed"] == 0
    assert [r.text for r in by[2]] == ["", ""] and [r["__n_removed"] for r in by[2]] == [8, 8]
    assert by[3][0].text == "and an end" and by[4][0].text is None
    assert by[7][0].text == "the same line again and again" and by[5][0].text == ""
    assert sorted((r.text or "") for r in by[None]) == ["", ""]  # null ids come last in the order
    assert without_repeated_lines(odd).columns == odd.columns


# ---- suffixes

def test_suffix_dedup(documents):
    want = brute.suffix_dedup(pairs(documents))
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), bytes(r.kept)) for r in suffix_dedup(documents).collect()}
    assert got == want
    assert sum(b for _, b, _, _ in want.values()) > 1000


@pytest.mark.parametrize("options", [{}, {"bucket_regions": 1}, {"filter_bits": 64}])
def test_suffix_dedup_shapes(spark, options):
    """Periodic texts, overlaps, edges of shared passages, crowded buckets and a full filter."""
    rng = random.Random(4)
    base = ["".join(rng.choices("abcdé ", k=rng.randint(90, 300))) for _ in range(8)]
    rows = [(200, None), (201, ""), (202, "a" * 400), (203, "ab" * 200), (204, "a" * 99), (205, "a" * 100)]
    for i in range(60):
        x = "".join(rng.choice(base)[rng.randint(0, 40):][:rng.randint(80, 300)] + rng.choice(["", "x", "yy"])
                    for _ in range(rng.randint(0, 4)))
        rows.append((i, x))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), bytes(r.kept)) for r in suffix_dedup(docs, **options).collect()}
    assert got == brute.suffix_dedup(rows)


def test_suffix_dedup_odd(odd):
    got = suffix_dedup(odd).collect()
    assert len(got) == odd.count()
    first = [r for r in got if r.doc_id == 1][0]
    copies = [r for r in got if r.doc_id == 2]
    assert len(first.removed) == 0 and len(copies) == 2 and all(r.kept == b"" for r in copies)


def test_suffix_spans_of_a_hot_document(spark, monkeypatch):
    """A document repeated 2,000 times in 16 partitions collects the spans of one copy."""
    from screenroi.llm import suffix_dedup as module

    rng = random.Random(4)
    text = "".join(rng.choices("abcdefgh ", k=3000))
    seen = []
    plain = module.spans_of_documents

    def spy(spans):
        out = plain(spans)
        seen.append({r["__id"]: r.n for r in out.selectExpr("__id", "size(spans) AS n").collect()})
        return out

    monkeypatch.setattr(module, "spans_of_documents", spy)
    first = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for copies in (1, 2000):
        hot = spark.range(copies).selectExpr("2L AS doc_id").withColumn("text", F.lit("x" + text)).repartition(16)
        got = suffix_dedup(first.union(hot)).collect()
        assert len(got) == copies + 1 and {len(r.kept) for r in got if r.doc_id == 2} == {1}
    assert seen[0][2] == seen[1][2]


def test_refine_tells_strings_apart():
    data = np.frombuffer(("ab" * 90 + "abc" * 60 + "ab" * 70).encode(), np.uint8)
    ends = np.array([0, 180, 360, 500])
    place, bucket = refine(data, ends, 100)
    strings = [bytes(data[p:p + 100]) for p in place]
    assert len(set(zip(strings, bucket.tolist(), strict=True))) == len(set(strings)) == len(set(bucket.tolist()))
    assert len(place) == 81 + 81 + 41


# ---- SimHash

@pytest.mark.parametrize("table", ["documents", "odd"])
def test_simhash(table, request):
    docs = request.getfixturevalue(table)
    rows = pairs(docs)
    prints = [(i, brute.simhash(t)) for i, t in rows]
    want = sorted((str(i), f"{p:016x}", str(c)) for (i, p), c in zip(prints, brute.components(prints), strict=True))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash_dedup(docs).collect())
    assert got == want
    lower = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash_dedup(docs, node_limit=1).collect())
    assert lower == want
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(brute.components(
        [(k, p) for k, (_, p) in enumerate(prints)])))


def test_gray_index_finds_all_links():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flips = [base]
    for _ in range(40):
        one, two = (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64) for _ in range(2))
        flips.append(base ^ one ^ two)
    codes = np.unique(np.concatenate(flips))
    index = GrayIndex(codes)
    assert (np.diff(gray_rank(index.codes).astype(object)) > 0).all()
    got = {(int(index.codes[i]), int(index.codes[j])) for a, b in index.links(2) for i, j in zip(a, b, strict=True)}
    want = {(int(x), int(y)) for x in codes for y in codes if x != y and int(x ^ y).bit_count() <= 2}
    assert got | {(b, a) for a, b in got} == want
    assert len(node_links(codes)) <= len(codes) - 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.v: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


@pytest.mark.parametrize("operator", [exact_dedup, line_dedup_digest, suffix_dedup, simhash_dedup, keep_one_of_each,
                                      without_repeated_lines])
def test_empty(operator, empty):
    assert operator(empty).count() == 0


def test_normalised_text_ignores_only_white_space(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "a b"), (4, "a\x0bb\r\n")], "doc_id long, text string")
    keep = {r.doc_id: r.keep_id for r in exact_dedup(docs).collect()}
    assert keep == {1: 4, 2: 4, 3: 3, 4: 4}
    assert re.sub("[\x20\x09-\x0D]", "", "a\x0bb\r\n") == "ab"
