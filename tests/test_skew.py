"""One tag holding a third of all rows, with broadcasts disabled (large-registry plans):
results stay whole and exact, and keep-latest still trims before its shuffle."""
import datetime as dt
import random
from collections import defaultdict
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from herdflow.operators.dedup import dedup_latest, duplicate_keys, latest_order
from herdflow.operators.enrich import enrich
from herdflow.operators.repair import fill_device
from herdflow.sources.snapshots import asof_join

N = 3000
HOT = "777"


@contextmanager
def no_broadcast(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


@pytest.fixture(scope="module")
def weigh(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(N):
        tag = HOT if i % 3 == 0 else str(rnd.randint(1, 200))
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 9))
        rows.append((i, tag, day, f"{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}",
                     float(rnd.randint(60, 900)), rnd.choice(["CIMA1", "CIMA2", None])))
    return rows, spark.createDataFrame(rows, "id int, ear_tag string, date date, time string, weight_kg double, "
                                             "device string")


def test_enrich_hot_tag_sort_merge(spark, weigh):
    rows, df = weigh
    herd = spark.createDataFrame([(dt.date(2024, 1, 20), str(k + 1000), str(k), 100 + k, None, 0)
                                  for k in list(range(1, 201)) + [777]],
                                 "date date, no string, transp_2 string, age_days int, dim int, lac_no int")
    with no_broadcast(spark):
        out = enrich(df, herd)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: (r["no"], r["age_days"]) for r in out.collect()}
    assert "SortMergeJoin" in plan
    assert len(got) == N
    for i, tag, day, *_ in rows:
        want_age = 100 + int(tag) - (dt.date(2024, 1, 20) - day).days
        assert got[i] == (str(int(tag) + 1000), want_age)


def test_keep_latest_hot_key(spark, weigh):
    rows, df = weigh
    with no_broadcast(spark):
        out = dedup_latest(df.withColumn("loaded_at", F.lit(None).cast("timestamp")),
                           ["date", "ear_tag", "device"], latest_order())
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {(r["date"], r["ear_tag"], r["device"]): (r["time"], r["weight_kg"]) for r in out.collect()}
    assert plan.count("WindowGroupLimit") == 2
    best = {}
    for _, tag, day, time_, w, dev in rows:
        k = (day, tag, dev)
        best[k] = max(best.get(k, (time_, w)), (time_, w))
    assert got == best


def test_duplicates_and_device_repair_hot_key(spark, weigh):
    rows, df = weigh
    with no_broadcast(spark):
        dups = duplicate_keys(df, ["date", "ear_tag"]).collect()
        filled = fill_device(df.withColumn("source", F.lit("PTM"))).collect()
    counts = defaultdict(int)
    for _, tag, day, *_ in rows:
        counts[(day, tag)] += 1
    assert len(dups) == sum(n for n in counts.values() if n > 1)
    mins = {}
    for _, tag, day, _, _, dev in rows:
        if dev is not None:
            mins[(day, tag)] = min(mins.get((day, tag), dev), dev)
    assert len(filled) == N and all(r["device"] is not None for r in filled)
    nulls = {r[0] for r in rows if r[5] is None}
    for r in filled:
        if r["id"] in nulls:
            assert r["device"] == mins.get((r["date"], r["ear_tag"]), "CIMA2")


def test_asof_hot_key(spark, weigh):
    rows, df = weigh
    snaps = spark.createDataFrame([(HOT, dt.date(2024, 1, d), d) for d in (1, 4, 8)] +
                                  [("5", dt.date(2024, 1, 3), 99)], "ear_tag string, d date, v int")
    with no_broadcast(spark):
        got = {r["id"]: r["v"] for r in asof_join(df, snaps, "ear_tag", "date", "d", ["v"]).collect()}
    assert len(got) == N
    for i, tag, day, *_ in rows:
        if tag == HOT:
            cands = [d for d in (1, 4, 8) if dt.date(2024, 1, d) <= day]
            assert got[i] == (max(cands) if cands else None)
        elif tag == "5":
            assert got[i] == (99 if day >= dt.date(2024, 1, 3) else None)
        else:
            assert got[i] is None
