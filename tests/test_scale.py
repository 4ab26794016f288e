"""What must not grow faster than the input: the data of a task, and bytes that are moved or stored."""

import os

import pytest
from pyspark.sql import functions as F

from screenroi.functions.domain import performance_key
from screenroi.operators.cleaners import clean_watch_history
from screenroi.operators.incremental import FactStore, absent_facts, with_made_ids, without_made_ids
from screenroi.operators.licensing import pick_license
from screenroi.operators.metrics import NO_YEAR, content_performance
from screenroi.operators.quality import fact_checks, fact_state, repeated_keys
from screenroi.operators.warehouse import STAGING_SCHEMA, Warehouse, fact_rows, load_staging
from screenroi.plans import catalog
from screenroi.session import TASK_INPUT, size_shuffles, stored
from screenroi.sources import bindings as b
from screenroi.sources import files

from conftest import rows
from test_incremental import physical, staging

SF = "/root/testdata/sf0.001"
KEYS = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]


@pytest.fixture
def own(spark):
    """The session's own settings, found again afterwards."""
    before = {k: spark.conf.get(k, None) for k in KEYS}
    yield before
    size_shuffles(spark, 0)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def parts(folder):
    return [n for n in os.listdir(folder.removeprefix("file:")) if n.endswith(".parquet")]


def made(spark, years, n=40):
    """Staging whose ids are made of title, region and year."""
    st = staging(spark, years, n).withColumn("region", F.coalesce("region", F.lit("GB"))).withColumn("title_id", F.concat("title_id", F.expr("total_watch_hours")))
    return st.withColumn("performance_id", performance_key(F.col("title_id"), F.col("region"), F.col("year"))).select(*STAGING_SCHEMA.fieldNames())


def test_tasks_grow_with_the_input(spark, own):
    assert size_shuffles(spark, TASK_INPUT) == 1
    assert {k: spark.conf.get(k, None) for k in KEYS} == own
    for tasks in (500, 1000):
        assert size_shuffles(spark, TASK_INPUT * tasks - 1) == tasks
        assert spark.conf.get(KEYS[0]) == str(tasks) and spark.conf.get(KEYS[1]) == "8m"
        usage = spark.createDataFrame([("t", "US", 2020)], "title_id string, region string, year int")
        lic = spark.createDataFrame([("t", "US", 1.0, 2019)],
                                    "title_id string, license_region string, license_cost_usd_millions double, license_year int")
        assert "REPARTITION_BY_NUM, [plan_id" in physical(pick_license(usage, lic)) and f", {tasks})" in physical(pick_license(usage, lic))
    spark.conf.set(KEYS[0], "700")  # what the user sets meanwhile stays
    assert size_shuffles(spark, TASK_INPUT * 600) == 600
    assert spark.conf.get(KEYS[0]) == "700" and spark.conf.get(KEYS[1], None) == own[KEYS[1]]


def test_flows_are_sized_by_their_tables(spark, own, monkeypatch):
    size = sum(os.path.getsize(f"{SF}/{t}") for t in catalog.READ)
    monkeypatch.setattr("screenroi.session.TASK_INPUT", size // 30)
    flow = catalog.Flow(spark, SF, fresh=True)
    assert flow.tasks in (30, 31) and spark.conf.get(KEYS[0]) == str(flow.tasks)
    # a task sorts a bucket, so buckets are as many
    assert len(parts(catalog._bucketed(flow)["fact"].inputFiles()[0].rsplit("/", 1)[0])) > 8


@pytest.mark.parametrize("name", ["output_conformance", "licence_gate", "content_performance"])
def test_users_of_the_pick_are_dealt_by_their_input(spark, own, monkeypatch, name):
    size = sum(os.path.getsize(f"{SF}/{t}") for t in catalog.READ)
    monkeypatch.setattr("screenroi.session.TASK_INPUT", size // 30)
    plan = physical(catalog.QUERIES[name](spark, SF))
    tasks = spark.conf.get(KEYS[0])
    assert tasks in ("30", "31")
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    assert dealt and all(f", {tasks}), " in line for line in dealt)
    assert sum("REPARTITION_BY_NUM" in line for line in dealt) == 1  # the pick, which is not coalesced


def test_staging_is_stored_without_made_ids(spark):
    flow = catalog.Flow(spark, SF, fresh=True)
    found = flow.staging
    assert found.columns == STAGING_SCHEMA.fieldNames()
    files = found.inputFiles()
    assert "performance_id" not in spark.read.parquet(*files).columns
    cp = content_performance(flow.watch, flow.licensing, flow.movies, flow.sentiment)
    want = load_staging(cp, churn=b.churn_input(flow.watch))
    assert rows(found) == rows(want)


def test_churn_is_dealt_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flow = catalog.Flow(spark, SF)
        args = flow.watch, flow.licensing, flow.movies, flow.sentiment
        twice = content_performance(*args, churn=b.churn_input(flow.watch))
        once = content_performance(*args, churn=b.churn_input(flow.watch, NO_YEAR))
        assert physical(once).count("Exchange hashpartitioning") == physical(twice).count("Exchange hashpartitioning") - 1
        assert rows(once) == rows(twice) and once.filter("year IS NULL AND churn_rate_post_title IS NOT NULL").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_written_ids_are_packed(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.create()
    assert wh.load(made(spark, [2000, 2001]), tables=["dim_date"]) == {"dim_date": 2}
    assert wh.load(made(spark, [2000, 2001])) | {"dim_region": 0} == {"dim_title": 40, "dim_region": 0, "dim_date": 0, "fact_content_performance": 80}
    assert all(".zstd." in n for n in parts(stored(made(spark, [2000]), "packed").inputFiles()[0].rsplit("/", 1)[0]))
    assert any(".zstd." in n for n in parts(f"{scratch}/wh/fact_content_performance"))


def test_ids_that_are_not_made_stay(spark):
    facts = fact_rows(made(spark, [2000]).unionByName(staging(spark, [2001])))
    slim = without_made_ids(facts)
    assert slim.filter("__own_id IS NULL").count() == 40 and slim.filter("__own_id IS NOT NULL").count() == 6
    assert rows(with_made_ids(slim)) == rows(facts) and with_made_ids(slim).columns == facts.columns


def test_the_state_of_a_load_moves_no_ids(spark, scratch):
    batch = made(spark, [2000, 2001])
    batch = fact_rows(batch.unionByName(batch.filter("year = 2000 AND total_watch_hours < 3")).unionByName(staging(spark, [2003])))
    batch = batch.withColumn("performance_id", F.when(F.col("date_id") != 20030101, F.col("performance_id")))
    assert repeated_keys(batch, "performance_id").first()[0] == 4  # three, and null
    got = {r.name: r.n for r in fact_state(batch).filter("kind = 'rule'").collect()}
    want = {r.rule: r.violations for r in fact_checks(batch, 1000).collect()}
    assert got["performance_id_unique"] == 4 == want["performance_id_unique"] and got["fact_performance_id_not_null"] == 6
    assert got["fact_rows"] == 89 and {k: v for k, v in want.items() if k in got} == {k: v for k, v in got.items() if k in want}
    assert not any("performance_id" in line for line in physical(fact_state(batch)).split("\n") if "Exchange hashpartitioning(__hash" in line)
    assert repeated_keys(batch.limit(0), "performance_id").first()[0] == 0


def test_digests_are_sent_in_place_of_the_batch(spark, scratch):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = FactStore(spark, f"{scratch}/store")
        first, second = made(spark, [2000, 2001]), made(spark, [2001, 2002])
        assert store.load(first) == 80 and "BroadcastHashJoin [date_id" in physical(store.new_rows(second))
        assert store.load(second) == 40 and store.load(second) == 0
        assert rows(store.table()) == rows(fact_rows(first.unionByName(second.filter("year = 2002"))))
        assert "hashpartitioning(date_id" not in "".join(l for l in physical(store.new_rows(second)).split("\n") if "slot" in l and "__slot" in l)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def exchanges(df):
    return [line for line in physical(df).split("\n") if "Exchange hashpartitioning(" in line]


def test_facts_are_stored_without_made_ids(spark, scratch):
    store = FactStore(spark, f"{scratch}/store")
    first = made(spark, [2000, 2001]).unionByName(staging(spark, [2001]))
    assert store.load(first) == 86 and rows(store.table()) == rows(fact_rows(first))
    kept = spark.read.parquet(f"{scratch}/store/fact/load=0")
    assert kept.filter("performance_id IS NULL").count() == 80 and kept.filter("performance_id IS NOT NULL").count() == 6
    fact_rows(made(spark, [2002])).write.partitionBy("date_id").parquet(f"{scratch}/store/fact/load=1")  # with all ids, as older files
    assert rows(store.table()) == rows(fact_rows(first.unionByName(made(spark, [2002]))))


def test_stored_facts_are_met_without_their_ids(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = fact_rows(made(spark, [2000, 2001])).localCheckpoint()
        other = fact_rows(staging(spark, [2000, 2002])).localCheckpoint()
        # rows of another title that bear an id made of a stored one, under its date and another
        like = known.filter("date_id = 20000101").limit(1).withColumn("title_id", F.lit("else")).localCheckpoint()
        facts = known.filter("date_id = 20000101").unionByName(other).unionByName(like).unionByName(like.withColumn("date_id", F.lit(20030101))).localCheckpoint()
        found = absent_facts(facts, known)
        assert rows(found) == rows(facts.join(known, ["date_id", "performance_id"], "left_anti").select(*facts.columns)) and found.count() == 13
        assert found.columns == facts.columns and absent_facts(known, facts).count() == 40
        join = absent_facts(facts, known)._jdf.queryExecution().optimizedPlan()
        while join.nodeName() == "Project":
            join = join.children().head()
        moved = [str(side.output()) for side in (join.children().head(), join.children().last())]
        assert join.nodeName() == "Join" and not any("performance_id" in names for names in moved) and "__hash" in moved[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_plays_leave_behind_what_is_not_read(spark):
    raw = b.watch_history_raw(b.Tables(spark, SF))
    again = raw.withColumns({"Session ID": F.regexp_replace("Session ID", "-.*", ""), "device_type": F.lit("x")})  # many rows a session
    for source in (raw, again):
        whole = clean_watch_history(source)
        short = clean_watch_history(source, last="region")
        assert short.columns == whole.columns[:10] and rows(short) == rows(whole.select(*short.columns))
    assert not {"is_download", "user_rating"} & set(short.columns)
    flow = catalog.Flow(spark, SF, fresh=True)
    assert "l_tax" in physical(flow.watch) and not any("l_tax" in physical(df) for df in (flow.usage, flow.content_performance))
    kept = spark.read.parquet(*flow.curated_watch.inputFiles())
    assert sorted(kept.columns) == sorted(catalog.PLAY_COLUMNS) and rows(kept) == rows(flow.watch.select(*kept.columns))


def test_suppliers_are_sent_to_order_lines(spark, monkeypatch):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = b.licensing_raw(b.Tables(spark, SF))
        assert not any("l_suppkey" in line.split("[plan_id")[0] for line in exchanges(sent))
        monkeypatch.setattr(b, "SENT_SUPPLIERS", 0)
        dealt = b.licensing_raw(b.Tables(spark, SF))
        assert any("l_suppkey" in line for line in exchanges(dealt)) and rows(sent) == rows(dealt)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_content_performance_is_dealt_without_made_ids(spark, scratch, monkeypatch):
    dealt = []
    monkeypatch.setattr(files, "by_partition", lambda df, columns, f=files.by_partition: dealt.append(df) or f(df, columns))
    data = [(f"t{i}", r, y, float(i)) for i in range(9) for r in ("US", None, "") for y in (2000, None)]
    cp = spark.createDataFrame(data, "title_id string, region string, year int, hours double")
    key = performance_key(F.col("title_id"), F.col("region"), F.col("year"))
    cp = cp.select(F.when(F.col("hours") == 1, F.lit("own")).when(F.col("hours") != 2, key).alias("performance_id"), *cp.columns)
    files.write_content_performance(cp, f"{scratch}/cp")
    back = spark.read.parquet(f"{scratch}/cp")
    assert back.columns == [*cp.columns, "region_partition", "year_partition"]
    assert rows(back.select(*cp.columns)) == rows(cp) and back.filter("performance_id IS NULL").count() == 6 == back.filter("performance_id = 'own'").count()
    assert dealt[0].columns == [*cp.columns[1:], "__own"] and dealt[0].filter("__own IS NULL").count() == 42
    assert back.filter("year_partition <=> year").count() == 54 and all(".zstd." in f for f in back.inputFiles())
