"""The chained stages, each on its predecessor's written result, and the registered queries."""

import collections

import duckdb
import pytest

import corpus_pipeline
from screenroi.llm.catalog import ORACLE_SQL, QUERIES
from screenroi.llm.common import materialize

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs, seen = documents, [documents]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        seen.append(docs)
    start, judged, lines, single, mixed, packed = seen
    assert all(d.columns == start.columns for d in seen[:-1])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert ids[1] < ids[0] and ids[2] == ids[1] and ids[3] <= ids[2] and ids[4] == ids[3] == ids[5]
    want = brute.line_dedup(sorted((r.doc_id, r.text) for r in judged.collect()))
    assert {r.doc_id: r.text for r in lines.collect()} == {k: v[2] for k, v in want.items()}
    rows = sorted((r.doc_id, r.text) for r in lines.collect())
    least = brute.components([(i, brute.simhash(t)) for i, t in rows])
    assert ids[3] == set(least)
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    uses = collections.Counter(r.doc_id for r in mixed.collect())
    assert collections.Counter(r.doc_id for r in packed.filter("piece = 0").collect()) == uses
    run = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(run.select(columns).collect()) == sorted(packed.select(columns).collect())


def test_stages_on_odd_and_empty(spark, odd, empty):
    ids = []
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"odd-{name}")
        ids.append(sorted((r.doc_id or 0) for r in docs.collect()))
    # the base rules leave the long pages; copies, also across ids, become one of their least id
    assert ids[0] == ids[1] == [0, 1, 2, 2, 3]
    assert set(ids[2]) <= set(ids[1]) and 1 in ids[2] and set(ids[3]) == set(ids[2]) == set(ids[4])
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"none-{name}")
        assert docs.count() == 0


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    twin = con.sql(ORACLE_SQL[name])
    names = sorted(twin.columns)
    want = sorted(tuple(r[twin.columns.index(c)] for c in names) for r in twin.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == names
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == want
