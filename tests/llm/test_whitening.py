"""Bit-sliced sums against plain integer products; whitening against numpy over the distinct vectors."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from screenroi.llm import whitening as w


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 130), st.integers(1, 4), st.integers(0, 2 ** 32), st.sampled_from([1, 3, 200, 2 ** 31, 2 ** 61]))
def test_cross_sums_are_exact(rows, width, seed, most):
    x = np.random.default_rng(seed).integers(-most, most + 1, (rows, width))
    sums, products = w.cross_sums(x)
    own = x.astype(object)
    assert sums == own.sum(axis=0).tolist()
    for i in range(width):
        for j in range(i, width):
            assert products[i, j] == (own[:, i] * own[:, j]).sum()


def brute(vectors):
    """{position in the list: x} of rows that stay, and what numpy makes of the distinct ones."""
    whole = {k: tuple(math.floor(256 * c) for c in v) for k, v in enumerate(vectors)
             if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = np.array(sorted(set(whole.values())), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = ((fit * n - s) / n).astype(float)
    cov = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(cov)
    return whole, n, s, cov, values[::-1], vectors_[:, ::-1].T


@pytest.mark.parametrize("width, block", [(3, 8192), (6, 64), (2, 1)])
def test_equals_numpy(spark, monkeypatch, width, block):
    monkeypatch.setattr(w, "BLOCK", block)
    rng = np.random.default_rng(width)
    vectors = [[float(np.float32(c)) for c in rng.normal(size=width) * (1 + np.arange(width))] for _ in range(150)]
    vectors += [vectors[0]] * 100 + [None, [], [None] * width, [float("nan")] * width, [1.0] * (width - 1) + [float("inf")], [1.0] * (width + 1)]
    rows = [(k % 200, v, "x", k) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, component int").repartition(5)
    kept, n, s, cov, values, components = brute(vectors[:-1])
    want = {}
    for k, x in kept.items():
        far = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        white = components @ ((np.array(x, dtype=object) * n - s) / n).astype(float) / np.sqrt(values)
        want.setdefault(k % 200, []).append((far, np.abs(white)))
    found = w.whiten(table).collect()
    m = min(4, width)
    assert len(found) == m * sum(map(len, want.values())) and {r.n for r in found} == {n}
    for r in found:
        i = r.component - 1
        assert abs(r.explained - values[i] / np.trace(cov)) < 1e-12 and r.identity_error < 1e-9
        assert any(r.deviation == far and abs(abs(r.whitened) - white[i]) < 1e-9 for far, white in want[r.vec_id])
    assert sorted((r.vec_id, r.component) for r in found) == sorted((k, c) for k in want for _ in want[k] for c in range(1, m + 1))


def test_nothing_varies_and_empty(spark):
    table = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [0.5, 0.25])], "vec_id long, embedding array<float>")
    rows = w.whiten(table).collect()
    assert len(rows) == 6 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in rows)
    none = w.whiten(table.limit(0))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = spark.createDataFrame([(k, [float(k), 2.0 * k]) for k in range(5)], "vec_id long, embedding array<double>")
    assert all((r.whitened is None) == (r.component == 2) for r in w.whiten(line).collect())


def test_huge_entries(spark):
    """Deviations beyond a long are null; entries beyond the whole numbers of a long are taken at their ends."""
    table = spark.createDataFrame([(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [3.0, 1.0])], "vec_id long, embedding array<double>")
    rows = w.whiten(table, components=1).collect()
    assert len(rows) == 3 and all(r.deviation is None or r.deviation >= 0 for r in rows)
    assert abs(rows[0].explained - 1) < 1e-9 and rows[0].identity_error < 1e-9


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [r.embedding for r in table.orderBy("vec_id").collect()]
    kept, n, _, cov, values, _ = brute(vectors)
    rows = w.whiten(table).collect()
    assert len(rows) == 4 * len(kept) and {r.n for r in rows} == {n}
    assert all(abs(r.explained - values[r.component - 1] / np.trace(cov)) < 1e-10 for r in rows)
