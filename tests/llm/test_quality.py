"""Quality rules: base counts against brute force, the estimate against numpy, verdicts on labels."""

import math

import numpy as np
import pytest

from screenroi.llm import quality_rules as q

from . import brute


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_base_counts(table, request):
    docs = request.getfixturevalue(table)
    got = q.quality_rules(docs).collect()
    want = sorted(brute.base_counts(r.text) for r in docs.collect())
    counts = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert counts == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_verdicts_on_labels(spark):
    """Junk goes, documents labelled good stay."""
    sf = "/root/testdata/sf0.01"
    rows = q.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert all(good) and len(good) > 300
    assert sum(junk) <= 0.1 * len(junk) and len(junk) > 20


def test_repetition_alone_rejects(spark):
    """Repeated lines or repeated words alone pass the cutoff, below the base rule's share."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    line = lambda n: " ".join(word() for _ in range(n))
    texts = ["\n".join(line(10) for _ in range(20)) for _ in range(80)]
    texts.append("\n".join(f"{line(10)}\nsevera common wordss" for _ in range(20)))  # 19 repeated lines, windows differ
    twice = line(100)
    texts.append("\n".join([twice, *(line(10) for _ in range(80)), twice]))  # 200 of 1,000 words
    docs = spark.createDataFrame([(k, x, "en", "a") for k, x in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = {r.doc_id: r for r in q.quality_rules(docs).collect()}
    assert (rows[80].n_dup_lines, rows[80].n_repeat_words) == (19, 0)
    assert (rows[81].n_dup_lines, rows[81].n_repeat_words) == (1, 200)
    assert not any(r.base_failed for r in rows.values())
    assert {k for k, r in rows.items() if not r.kept} == {80, 81}


def _vectors(spark, points, pool="p"):
    return spark.createDataFrame([(pool, *map(int, p), 1) for p in points],
                                 "pool string, " + ", ".join(f"{s} long" for s in q.STATS) + ", n long")


def test_estimate_resists_outliers(spark):
    """A fifth of far points moves neither centre nor scatter much; plain moments would follow them."""
    rng = np.random.default_rng(0)
    clean = rng.multivariate_normal([1000, 500, 900, 700], np.diag([300, 250, 400, 350]) ** 2, 800)
    far = rng.normal(9000, 100, (200, 4))
    vectors = _vectors(spark, np.concatenate([clean, far])).cache()
    estimate = q.minimum_determinant(vectors)
    r = estimate.first()
    centre = [r[f"m_{i}"] for i in range(4)]
    assert np.abs(np.array(centre) - clean.mean(axis=0)).max() < 120
    lower = np.zeros((4, 4))
    for i, j in q.PAIRS:
        lower[i, j] = r[f"l_{i}_{j}"]
    spread = np.sqrt(np.diag(lower @ lower.T))
    assert (spread < 2.2 * clean.std(axis=0) + np.array(q.SPREAD_FLOOR)).all()
    d2 = {row.d2 for row in q._with_distance(vectors, estimate).filter("s_word_len > 8000").collect()}
    assert min(d2) > q.CUTOFF


def test_large_shares_of_junk(spark):
    """Up to 45 % of a pool may be far off: all of it is outside the cutoff, and nearly all the rest inside."""
    rng = np.random.default_rng(7)
    far_off = {"one side": [3500, 2500, 5200, 6900], "both sides": [3500, 2500, 5200, 6900], "near": [2600, 1500, 2600, 4500]}
    clean, vectors = {}, None
    for place, centre in far_off.items():
        for share in (0.3, 0.4):
            far = int(500 * share)
            good = rng.multivariate_normal([1500, 300, 400, 600], np.diag([150, 100, 400, 500]) ** 2, 500 - far)
            junk = rng.normal(centre, 60, (far, 4))
            if place == "both sides":
                junk[: far // 2, :2] = rng.normal([100, 2500], 60, (far // 2, 2))
            pool = f"{place} {share}"
            clean[pool] = {tuple(map(int, p)) for p in good}
            own = _vectors(spark, np.concatenate([good, junk]), pool)
            vectors = own if vectors is None else vectors.unionByName(own)
    vectors = q.materialize(vectors, "test-vectors")
    wrong = dict.fromkeys(clean, 0)
    for r in q._with_distance(vectors, q.minimum_determinant(vectors)).collect():
        if tuple(r[s] for s in q.STATS) in clean[r.pool]:
            wrong[r.pool] += r.d2 > q.CUTOFF
        else:
            assert r.d2 > q.CUTOFF, r
    assert len(wrong) == 6 and max(wrong.values()) < 4


def _fast_mcd(points, tries=200):
    """Random starts of six rows, steps on single rows to the end, least determinant, reweighted: in numpy."""
    rng = np.random.default_rng(2)
    floor = np.diag(np.square(q.SPREAD_FLOOR))
    h = math.ceil(len(points) * q.SUBSET)

    def distance(centre, scatter):
        y = points - centre
        return np.einsum("ij,ij->i", y @ np.linalg.inv(scatter), y)

    best = None
    for _ in range(tries):
        own = points[rng.choice(len(points), 6, replace=False)]
        own = points[np.argsort(distance(own.mean(axis=0), np.cov(own.T, bias=True) + floor), kind="stable")[:h]]
        last = math.inf
        while True:
            scatter = np.cov(own.T, bias=True) * q.CONSISTENCY + floor
            det = np.linalg.slogdet(scatter)[1]
            if det >= last - 1e-12:
                break
            last, centre, kept = det, own.mean(axis=0), scatter
            own = points[np.argsort(distance(centre, scatter), kind="stable")[:h]]
        if best is None or last < best[0]:
            best = last, centre, kept
    inside = points[distance(best[1], best[2]) <= q.WEIGHT_CUT]
    return best[0], inside.mean(axis=0), np.cov(inside.T, bias=True) * q._consistency(q.WEIGHT_P) + floor


def test_estimate_against_numpy(spark):
    """Two pools with junk in different places: centre, scatter and verdicts as from a search over 200 random starts."""
    rng = np.random.default_rng(3)
    mixed = np.array([[160, 0, 0, 0], [60, 110, 0, 0], [0, 90, 350, 0], [50, 0, 200, 450]])
    first = np.concatenate([[1500, 400, 900, 1500] + rng.standard_normal((400, 4)) @ mixed.T, rng.normal(5000, 80, (200, 4))])
    second = np.concatenate([[1400, 300, 0, 0] + np.abs(rng.standard_normal((500, 4)) @ mixed.T), rng.normal([900, 3000, 0, 0], 50, (60, 4))])
    pools = {"a": np.round(first), "b": np.round(second)}
    vectors = _vectors(spark, pools["a"], "a").unionByName(_vectors(spark, pools["b"], "b")).cache()
    estimates = q.minimum_determinant(vectors)
    judged = {}
    for r in q._with_distance(vectors, estimates).collect():
        judged.setdefault(r.pool, []).append(r.d2)
    for r in estimates.collect():
        _, centre, scatter = _fast_mcd(pools[r.pool])
        lower = np.zeros((4, 4))
        for i, j in q.PAIRS:
            lower[i, j] = r[f"l_{i}_{j}"]
        assert np.abs(np.array([r[f"m_{i}"] for i in range(4)]) - centre).max() < 40
        assert np.allclose(np.sqrt(np.diag(lower @ lower.T)), np.sqrt(np.diag(scatter)), rtol=0.05)
        assert math.isclose(r.log_det, np.linalg.slogdet(lower @ lower.T)[1], rel_tol=1e-9)
        y = pools[r.pool] - centre
        want = np.einsum("ij,ij->i", y @ np.linalg.inv(scatter), y) > q.CUTOFF
        assert np.mean((np.array(judged[r.pool]) > q.CUTOFF) != want) < 0.01


def test_least_determinant_is_kept(spark):
    rows = [("p", 0, 5.0), ("p", 1, 3.0), ("p", 2, 4.0), ("p", 3, 3.0), ("r", 0, 1.0)]
    tried = spark.createDataFrame(rows, "pool string, start int, log_det double")
    assert {(r.pool, r.start) for r in q._least(tried, 2).collect()} == {("p", 1), ("p", 3), ("r", 0)}
    assert {(r.pool, r.start) for r in q._least(tried, 1).collect()} == {("p", 1), ("r", 0)}


def test_distance_equals_numpy(spark):
    points = [[1000, 0, 100, 0], [1500, 200, 0, 50]]
    estimate = spark.createDataFrame([("p", 900.0, 100.0, 50.0, 20.0, 200.0, 10.0, 150.0, 5.0, 7.0, 220.0, 1.0, 2.0, 3.0, 160.0)],
                                     "pool string, " + ", ".join(f"m_{i} double" for i in range(4)) + ", "
                                     + ", ".join(f"l_{i}_{j} double" for i, j in q.PAIRS))
    lower = np.zeros((4, 4))
    for (i, j), x in zip(q.PAIRS, (200.0, 10.0, 150.0, 5.0, 7.0, 220.0, 1.0, 2.0, 3.0, 160.0), strict=True):
        lower[i, j] = x
    got = sorted(r.d2 for r in q._with_distance(_vectors(spark, points), estimate).collect())
    want = sorted(float(y @ y) for y in (np.linalg.solve(lower, np.array(p) - [900, 100, 50, 20]) for p in points))
    assert np.allclose(got, want)


def test_small_groups_pool(spark):
    sizes = spark.createDataFrame(
        [("g1", "en", "a", 60), ("g2", "en", "b", 30), ("g3", "en", "c", 30), ("g4", "de", "a", 10), ("g5", None, None, 45)],
        "`group` string, lang string, source string, n long")
    pools = {r.group: r.pool for r in q._pools(sizes).collect()}
    assert pools["g1"] == '{"lang":"en","source":"a"}'
    assert pools["g2"] == pools["g3"] == '{"lang":"en"}'
    assert pools["g4"] == pools["g5"] == "*"
    assert q._pools(sizes.filter("n < 20")).count() == 0


def test_chi2():
    assert abs(q._chi2_quantile(0.95, 4) - 9.4877) < 1e-3 and abs(q._chi2_cdf(5.385, 4) - 0.75) < 1e-3
    assert math.isclose(q._consistency(0.75), 1.4867, rel_tol=1e-2)
    draws = np.sort((np.random.default_rng(1).standard_normal((200_000, 4)) ** 2).sum(axis=1))
    nearest = draws[:int(q.SUBSET * len(draws))]
    assert math.isclose(q.CONSISTENCY, 4 / nearest.mean(), rel_tol=1e-2)


def test_keep_quality_columns(odd, empty):
    kept = q.keep_quality(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 2, 3]
    assert q.quality_rules(empty).count() == 0 and q.keep_quality(empty).count() == 0


def test_keep_quality_judges_rows_where_they_stand(spark):
    """One text under one id in two sources: kept where it is like the others, not where it is far from them."""
    words = [f"w{k:02d}xy" for k in range(60)]
    plain = [(k, " ".join(words[(k * 7 + j) % 60] for j in range(40 + k % 9)), "en", "a") for k in range(80)]
    odd_words = [f"verylongwordnumber{k:02d}indeed" for k in range(60)]
    other = [(1000 + k, " ".join(odd_words[(k * 7 + j) % 60] for j in range(40 + k % 9)), "en", "b") for k in range(80)]
    both = [(5000, plain[3][1], "en", "a"), (5000, plain[3][1], "en", "b"), (5000, plain[3][1], "en", "b")]
    docs = spark.createDataFrame(plain + other + both, "doc_id long, text string, lang string, source string")
    judged = q._judged(docs, [q.F.col("doc_id")]).filter("kept").select("doc_id", "lang", "source")
    want = sorted(map(tuple, judged.collect()))
    got = sorted((r.doc_id, r.lang, r.source) for r in q.keep_quality(docs).collect())
    assert got == want and (5000, "en", "a") in got and (5000, "en", "b") not in got
