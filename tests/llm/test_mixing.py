"""Temperature mixing against a plain-Python permutation."""

import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from screenroi.llm.mixing import SEED, mix_sources, mixing_order, mixing_plan


@pytest.fixture(scope="module")
def docs(documents):
    """One source with a third of the rows."""
    return documents.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))


def name(doc, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    return hashlib.md5(f"{'none' if doc is None else doc}:{inner}".encode()).hexdigest()


def key(epoch, row):
    return int(hashlib.md5(f"{SEED}:{epoch}:{name(*row)}".encode()).hexdigest()[:15], 16)


def tokens(text):
    return -(-len((text or "").encode()) // 4) + 1


def brute(rows, plan):
    """Counter of (doc_id, epoch) by sorting each pass and cutting the part pass at its budget; rows of one key
    come in together."""
    out = collections.Counter()
    for source, docs in rows.items():
        p = plan[source]
        budget = round(p["repeat"] * p["tokens"])
        passes, rest = divmod(budget, p["tokens"])
        for d, _ in docs:
            out.update((d, e) for e in range(passes))
        sets = collections.defaultdict(list)
        for row in docs:
            sets[key(passes, row)].append(row)
        used = 0
        for k in sorted(sets):
            used += sum(tokens(t) for _, t in sets[k])
            if used > rest:
                break
            out.update((d, passes) for d, _ in sets[k])
    return out


@pytest.mark.parametrize("options", [{}, {"target_entropy": 2.5}, {"budget": 20000}, {"max_repeat": 1.0}])
def test_uses_equal_brute_force(docs, options):
    plan = {r["__source"]: r.asDict() for r in mixing_plan(docs, **options).collect()}
    rows = collections.defaultdict(list)
    for r in docs.collect():
        rows[f'{{"source":"{r.source}"}}'].append((r.doc_id, r.text))
    assert {k: p["tokens"] for k, p in plan.items()} == {k: sum(tokens(t) for _, t in v) for k, v in rows.items()}
    got = mixing_order(docs, **options).collect()
    assert collections.Counter((r.doc_id, r.epoch) for r in got) == brute(rows, plan)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.key == key(r.epoch, (r.doc_id, texts[r.doc_id])) for r in got)
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(
        r.doc_id for r in mix_sources(docs, **options).collect())


def test_targets(docs):
    plan = mixing_plan(docs).collect()
    repeats = [r["repeat"] for r in plan]
    assert abs(max(repeats) - 2) < 1e-4 and min(repeats) == 1 and abs(sum(r.weight for r in plan) - 1) < 1e-6
    plan = mixing_plan(docs, target_entropy=2.5).collect()
    assert abs(-sum(r.weight * math.log(r.weight) for r in plan) - 2.5) < 1e-5
    plan = mixing_plan(docs, budget=20000).collect()
    assert abs(sum(r["repeat"] * r.tokens for r in plan) - 20000) < 1


def test_blocks_have_the_weights(documents):
    many = documents.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.lit("rest")))
    for k in range(4):
        many = many.unionByName(many.withColumn("doc_id", F.col("doc_id") + 10 ** (4 + k)))
    plan = {r["__source"]: r.weight for r in mixing_plan(many).collect()}
    share = mixing_order(many, block_tokens=480_000).groupBy("block").agg(
        (F.sum(F.when(F.col("source") == "hot", F.col("n_tokens"))) / F.sum("n_tokens")).alias("hot")).collect()
    assert len(share) >= 3
    assert all(abs(r.hot - plan['{"source":"hot"}']) < 0.06 for r in share)


def test_odd_and_empty(odd, empty):
    mixed = mix_sources(odd)
    assert mixed.columns == odd.columns
    uses = collections.Counter((r.doc_id, r.text) for r in mixed.collect())
    assert set(uses) == {(r.doc_id, r.text) for r in odd.collect()}  # nobody is left out by default
    assert mix_sources(empty).count() == 0 and mixing_order(empty).count() == 0


def test_an_id_of_a_third_of_the_rows(spark):
    """Its rows have places of their own: half of the budget is half of the rows."""
    docs = spark.range(6000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "concat('text ', id) AS text", "'s' AS source")
    total = sum(tokens(f"text {i}") for i in range(6000))
    for seed in (1, 2):
        used = mixing_order(docs, budget=total // 2, seed=seed)
        hot, sizes = used.filter("doc_id = 7").count(), used.agg(F.sum("n_tokens")).first()[0]
        assert 850 < hot < 1150 and 0 <= total // 2 - sizes <= 5


def test_texts_without_blanks_count_by_size(spark):
    docs = spark.createDataFrame([(1, "漢字" * 400, "zh"), (2, "word " * 480, "en")], "doc_id long, text string, source string")
    assert {r.tokens for r in mixing_plan(docs).collect()} == {601}


def test_targets_out_of_reach(documents):
    with pytest.raises(ValueError, match="entropy"):
        mixing_plan(documents, target_entropy=50.0)
    with pytest.raises(ValueError, match="entropy"):
        mixing_plan(documents, target_entropy=-0.1)
    with pytest.raises(ValueError, match="repeat"):
        mixing_plan(documents, budget=10 ** 12)
