"""Snapshot choice (J2) and row-level as-of join (J2b) against brute force."""
import datetime as dt
import random

from herdflow.sources.snapshots import asof_join, pick_snapshot, resolve_snapshot_date


def test_pick_snapshot_directions(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 10), dt.date(2024, 2, 3)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date date, v int")
    assert [r["v"] for r in pick_snapshot(df, "date", dt.date(2024, 1, 10), "backward").collect()] == [1]
    assert [r["v"] for r in pick_snapshot(df, "date", dt.date(2024, 1, 20), "backward").collect()] == [1]
    assert [r["v"] for r in pick_snapshot(df, "date", dt.date(2024, 1, 11), "forward").collect()] == [2]
    assert [r["v"] for r in pick_snapshot(df, "date", None, "latest").collect()] == [2]
    assert pick_snapshot(df, "date", dt.date(2023, 1, 1), "backward").count() == 0
    assert resolve_snapshot_date(df, "date", dt.date(2024, 3, 1), "forward") is None


def test_asof_join_matches_brute_force(spark):
    rnd = random.Random(11)
    base = dt.date(2024, 1, 1)
    snaps = {(k, base + dt.timedelta(days=rnd.randint(0, 60))) for k in range(8) for _ in range(6)}
    snap_rows = [(k, d, f"{k}@{d}") for k, d in snaps]
    fact_rows = [(i, rnd.randint(0, 9), base + dt.timedelta(days=rnd.randint(-5, 70))) for i in range(300)]
    s = spark.createDataFrame(snap_rows, "k int, d date, payload string")
    f = spark.createDataFrame(fact_rows, "id int, k int, day date")
    got = {r["id"]: r["payload"] for r in asof_join(f, s, "k", "day", "d", ["payload"]).collect()}
    for i, k, day in fact_rows:
        cands = [(d, p) for kk, d, p in snap_rows if kk == k and d <= day]
        assert got[i] == (max(cands)[1] if cands else None), (i, k, day)
    plan = asof_join(f, s, "k", "day", "d", ["payload"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
