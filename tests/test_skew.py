"""A title holding a third of all rows: results equal a plain-Python brute force."""

import datetime as dt
import random
import time
from collections import defaultdict

from screenroi.operators.cleaners import clean_watch_history
from screenroi.operators.licensing import pick_license
from screenroi.operators.metrics import prepare_usage, usage_by_title_region_year


def test_hot_title_usage_and_pick(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        title = "hot" if i % 3 == 0 else f"t{rng.randint(0, 40)}"
        session = f"s{i % 2600}"  # 400 sessions appear twice: dedupe keeps the smallest row
        rows.append((session, f"u{rng.randint(0, 300)}", title, f"{rng.choice([2019, 2020, 2021])}-0{rng.randint(1, 9)}-15",
                     str(rng.randint(1, 120)), rng.choice(["US", "GB", "usa"])))
    raw = spark.createDataFrame(rows, "session_id string, user_id string, movie_id string, watch_date string, "
                                      "watch_duration_minutes string, location_country string").repartition(6)
    usage = usage_by_title_region_year(prepare_usage(clean_watch_history(raw)))

    # Brute force: keep the smallest full row per session, then aggregate.
    best = {}
    for r in rows:
        key = (r[1], r[2], r[3], float(r[4]), r[5])
        if r[0] not in best or key < best[r[0]]:
            best[r[0]] = key
    agg = defaultdict(lambda: [0.0, set()])
    for user, title, day, minutes, region in best.values():
        reg = "US" if region.strip().upper() == "USA" else region.strip().upper()
        g = agg[(title, reg, int(day[:4]))]
        g[0] += minutes
        g[1].add(user)
    expected = {k: (v[0] / 60.0, len(v[1])) for k, v in agg.items()}
    got = {(r.title_id, r.region, r.year): (r.total_watch_hours, r.unique_viewers) for r in usage.collect()}
    assert got == expected

    lic = spark.createDataFrame(
        [("hot", "GB", 5.0, 2020), ("hot", "US", 7.0, 2020), ("hot", "US", 1.0, 2018)]
        + [(f"t{i}", "US", float(i), 2022) for i in range(0, 40, 2)],
        "title_id string, license_region string, license_cost_usd_millions double, license_year int")
    picked = {(r.title_id, r.region, r.year): (r.license_region, r.license_cost_usd_millions, r.license_year)
              for r in pick_license(usage, lic).collect()}
    assert picked[("hot", "GB", 2020)] == ("GB", 5.0, 2020)
    assert picked[("hot", "US", 2021)] == ("US", 7.0, 2020)
    assert picked[("hot", "GB", 2019)] == ("US", 1.0, 2018)
    assert all(t == "hot" or int(t[1:]) % 2 == 0 for t, _, _ in picked)
    assert all(v == ("US", float(t[1:]), 2022) for (t, _, _), v in picked.items() if t != "hot")


def test_pick_is_linear_in_a_title(spark):
    """20,000 usage groups and 20,000 licences of one title in regions without end."""
    usage = spark.range(20000).selectExpr("'t' AS title_id", "concat('r', id) AS region", "cast(1900 + id % 200 as int) AS year",
                                          "1.0D AS total_watch_hours", "1L AS unique_viewers")
    licences = spark.range(20000).selectExpr("'t' AS title_id", "concat('q', id) AS license_region",
                                             "cast(id as double) AS license_cost_usd_millions", "cast(1900 + id % 150 as int) AS license_year")
    start = time.perf_counter()
    rows = pick_license(usage, licences).collect()
    assert len(rows) == 20000 and time.perf_counter() - start < 20
    assert all(r.license_year == min(r.year, 2049) for r in rows)
