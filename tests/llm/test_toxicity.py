"""Factorization machine: pairs are learnt, labels of held-out rows are not read, bounds hold."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from screenroi.llm import toxicity as t


def test_learns_a_pair_that_weights_miss():
    """Toxic just if exactly both terms occur (a product, not a sum)."""
    rng = np.random.default_rng(0)
    on = rng.random((1200, 2)) < 0.5
    labels = (on[:, 0] == on[:, 1]).astype(float)  # not linear in the two
    row, term = np.nonzero(on)
    machine = t.FactorizationMachine([0, 1], 0.0)
    machine.fit(labels, row, term, np.ones(len(row), np.int64))
    z, _ = machine.margins(len(on), row, term, machine._value(np.ones(len(row))))
    assert ((z > 0) == (labels == 1)).mean() > 0.95


def _exactly_one(seed, n, share, fill):
    """(doc_id, text, toxic): toxic if exactly one of two words is in the text; both words and all others are
    neutral alone."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        on = rng.random(2) < share
        words = [f"word{i}" for i in rng.zipf(1.3, 30) % fill] + ["kettle"] * int(on[0]) + ["harbour"] * int(on[1])
        rng.shuffle(words)
        rows.append((k, " ".join(words), int(on[0] != on[1])))
    return rows


@pytest.mark.parametrize("fill", [400, 5000])
def test_pair_of_neutral_words_through_train(spark, fill):
    table = spark.createDataFrame(_exactly_one(3, 4000, 0.5, fill), "doc_id long, text string, toxic int")
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    machine = t.train(docs, labels)
    assert {t._bucket("w:kettle"), t._bucket("w:harbour")} <= machine.number.keys()
    rows = t.score(docs, machine).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 600 and np.mean([r.predicted == r.toxic for r in rows]) > 0.95


def test_interactions_against_logistic_fits():
    """Against likelihoods of logistic regressions with and without the product, by Newton's method."""
    rng = np.random.default_rng(2)
    x = (rng.random((800, 6)) < 0.4).astype(float)
    y = ((x[:, 0] != x[:, 1]) ^ (rng.random(800) < 0.2)).astype(float)

    def likelihood(columns):
        z, beta = np.column_stack([np.ones(len(y)), *columns]), np.zeros(len(columns) + 1)
        for _ in range(30):
            p = 1 / (1 + np.exp(-z @ beta))
            beta += np.linalg.solve(z.T * (p * (1 - p)) @ z, z.T @ (y - p))
        return (np.log(p) * y + np.log(1 - p) * (1 - y)).sum()

    row, term = np.nonzero(x)
    got, partner = t.interactions(y, row, term, 6, rows=64)
    assert partner[:2].tolist() == [1, 0]
    pair = [x[:, 0], x[:, 1]]
    want = 2 * (likelihood([*pair, pair[0] * pair[1]]) - likelihood(pair))
    assert np.allclose(got[:2], want, rtol=1e-3) and want > t.LEAST_INTERACTION and (got[2:] == 0).all()


def test_alternatives_are_no_interaction():
    """Any of two words makes a text clean: additive log odds say so, whatever the pair's table tells."""
    table = np.zeros((2, 2, 2, 1))
    table[0, 0, :, 0] = 1400, 600
    table[0, 1, 0], table[1, 0, 0], table[1, 1, 0] = 500, 500, 100
    assert t.three_way(table)[0] < 1
    table[:, :, :, 0] = [[[9000, 300], [300, 0]], [[300, 0], [0, 30]]]  # an insult just when both occur
    assert t.three_way(table)[0] > t.LEAST_INTERACTION


def test_bound_is_on_rows_with_a_hot_id(spark):
    """One labelled id holds most rows: repeats are one row, and different texts count against the bound."""
    labels = spark.range(1, 400).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    base = spark.range(1, 400).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    repeats = spark.range(5000).selectExpr("1L AS doc_id", "'text 1' AS text")
    assert not labels.filter("doc_id = 1").select(t.held_out()).first()[0]
    plain = t.training_rows(base, labels, most=1000)
    assert sorted(map(tuple, t.training_rows(base.union(repeats), labels, most=1000).collect())) == sorted(map(tuple, plain.collect()))
    different = spark.range(5000).selectExpr("1L AS doc_id", "concat('other ', id) AS text")
    bounded = t.training_rows(base.union(different), labels, most=300)
    assert bounded.count() == 300 and bounded.columns == plain.columns


def test_margin_equals_sum_over_pairs():
    machine = t.FactorizationMachine(list(range(5)), 0.3)
    machine.w = np.arange(5) / 7
    x = np.array([1.0, 2.0, 0.5])
    z, _ = machine.margins(1, np.zeros(3, np.int64), np.array([0, 2, 4]), x)
    terms = [0, 2, 4]
    want = 0.3 + sum(machine.w[k] * v for k, v in zip(terms, x, strict=True)) + sum(
        machine.v[terms[i]] @ machine.v[terms[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert np.isclose(z[0], want)


def test_counts_of_terms():
    counter = t.TermCounter(lambda b: b)
    row, term, count = counter.counts(pa.array(["Idiot, idiot! x", None, ""]))
    found = {(r, b): c for r, b, c in zip(row.tolist(), term.tolist(), count.tolist(), strict=True)}
    assert found[0, t._bucket("w:idiot")] == 2 and found[0, t._bucket("p:idi")] == 2
    assert {r for r, _ in found} == {0, 1, 2} and (2, t._bucket("w:x")) not in found  # each has a length


def test_many_telling_terms(spark):
    """Some 3,000 words of their own kind each, far more telling terms than a machine of 1,024 holds: a single
    word is told apart for most of them."""
    rng = np.random.default_rng(1)
    letters = "abcdefghijklmnopqrst"
    words = [a + b + c for a in letters for b in letters for c in letters]
    words = [words[k] for k in rng.permutation(len(words))[:3000]]
    kinds = [words[:1500], words[1500:]]
    rows = [(2 * k + kind, " ".join(kinds[kind][i] for i in rng.integers(0, 1500, 20)), kind)
            for k in range(1500) for kind in (0, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = t.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    scores = machine.scores(pa.array([w for kind in kinds for w in kind]), t.TermCounter(machine.number.get))
    neutral = machine.scores(pa.array(["zzz"]), t.TermCounter(machine.number.get))[0]
    assert (scores[:1500] < neutral).mean() > 0.5 and (scores[1500:] > neutral).mean() > 0.5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = t.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r.score for r in rows if r.toxic == 1]
    clean = [r.score for r in rows if r.toxic == 0]
    assert len(toxic) > 60 and sum(s >= 0.5 for s in toxic) > 0.85 * len(toxic)
    assert sum(s >= 0.5 for s in clean) < 0.01 * len(clean)


def test_held_out_labels_change_nothing(documents, labels):
    import zlib

    flipped = labels.withColumn("toxic", F.when(t.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in t.toxicity(documents, x).collect()) for x in (labels, flipped))
    assert a == b
    rows = t.toxicity(documents, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_odd_and_empty(odd, empty, labels):
    rows = t.toxicity(odd, labels.withColumn("toxic", F.lit(None).cast("int"))).collect()
    assert len(rows) == odd.count() and {round(r.score, 6) for r in rows} == {0.25}
    assert [r.held_out for r in rows if r.doc_id is None] == [True, True]
    both = labels.filter("doc_id < 12").withColumn("toxic", F.col("doc_id") % 2)
    assert t.toxicity(odd, both.union(both)).count() == odd.count()
    assert t.toxicity(empty, labels).count() == 0 and t.training_rows(odd, both, most=3).select("doc_id").distinct().count() <= 3
