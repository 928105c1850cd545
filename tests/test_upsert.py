"""Keep-latest master upsert (K3, W1, U1) on a day-partitioned table."""
import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from herdflow.operators.dedup import dedup_latest, latest_order
from herdflow.session import scratch_path
from herdflow.sinks.master import upsert_latest

SCHEMA = "date date, ear_tag string, device string, time string, weight_kg double, loaded_at timestamp"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_latest_batch_wins_and_other_months_untouched(spark):
    path = scratch_path(spark, "t-master")
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 400.0, t1),
                              (dt.date(2024, 2, 5), "1", "A", "07:00", 410.0, t1)]), path)
    jan = [f for f in os.listdir(path.replace("file:", "") + "/day=2024-01-05") if f.endswith(".parquet")]
    out = upsert_latest(_df(spark, [(dt.date(2024, 2, 5), "1", "A", "08:00", 420.0, t2),
                                    (dt.date(2024, 2, 6), "2", "A", "08:00", 430.0, t2)]), path)
    got = {(r["date"], r["ear_tag"]): r["weight_kg"] for r in out.collect()}
    assert got == {(dt.date(2024, 1, 5), "1"): 400.0, (dt.date(2024, 2, 5), "1"): 420.0,
                   (dt.date(2024, 2, 6), "2"): 430.0}
    jan_after = [f for f in os.listdir(path.replace("file:", "") + "/day=2024-01-05") if f.endswith(".parquet")]
    assert jan == jan_after            # the January partition was not rewritten
    assert not os.path.exists(path.replace("file:", "") + "/_staging") or \
        not os.listdir(path.replace("file:", "") + "/_staging")


def test_tie_inside_batch_is_deterministic(spark):
    t = dt.datetime(2024, 2, 1)
    rows = [(dt.date(2024, 1, 5), "1", "A", "07:00", 400.0, t), (dt.date(2024, 1, 5), "1", "A", "09:00", 390.0, t),
            (dt.date(2024, 1, 5), "1", "A", "09:00", 395.0, t)]
    out = dedup_latest(_df(spark, rows), ["date", "ear_tag", "device"], latest_order()).collect()
    assert [(r["time"], r["weight_kg"]) for r in out] == [("09:00", 395.0)]


def test_null_loaded_at_wins_and_null_keys_equal(spark):
    rows = [(dt.date(2024, 1, 5), "1", None, "07:00", 1.0, dt.datetime(2024, 3, 1)),
            (dt.date(2024, 1, 5), "1", None, "07:00", 2.0, None)]
    out = dedup_latest(_df(spark, rows), ["date", "ear_tag", "device"], latest_order()).collect()
    assert len(out) == 1 and out[0]["weight_kg"] == 2.0


def test_null_date_rows_survive_in_null_partition(spark):
    path = scratch_path(spark, "t-master")
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    upsert_latest(_df(spark, [(None, "1", "A", "07:00", 1.0, t1)]), path)
    out = upsert_latest(_df(spark, [(None, "1", "A", "07:00", 2.0, t2), (None, "2", "A", "07:00", 3.0, t2)]), path)
    assert sorted(r["weight_kg"] for r in out.collect()) == [2.0, 3.0]


def test_dry_run_writes_nothing(spark):
    path = scratch_path(spark, "t-master")
    t1 = dt.datetime(2024, 2, 1)
    out = upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 1.0, t1)]), path, write=False)
    assert out.count() == 1 and not os.path.exists(path.replace("file:", ""))


def test_reads_only_touched_days(spark):
    path = scratch_path(spark, "t-master")
    t1 = dt.datetime(2024, 2, 1)
    upsert_latest(_df(spark, [(dt.date(2024, m, 5), "1", "A", "07:00", 1.0, t1) for m in (1, 2, 3)]), path)
    merged = upsert_latest(_df(spark, [(dt.date(2024, 3, 5), "2", "A", "07:00", 1.0, t1)]), path, write=False)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-03-05" in plan
    assert merged.count() == 2          # the existing row of that day + the new one, nothing else
    assert merged.select(F.countDistinct("day")).first()[0] == 1


def test_empty_batch_changes_nothing(spark):
    path = scratch_path(spark, "t-master")
    t1 = dt.datetime(2024, 2, 1)
    upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 1.0, t1)]), path)
    out = upsert_latest(_df(spark, []), path)
    assert [r["weight_kg"] for r in out.collect()] == [1.0]


def test_empty_landing_batch(spark):
    from herdflow.sinks.landing import land_raw
    path = scratch_path(spark, "t-landing")
    raw = spark.createDataFrame([("1", "OP1", "2024-05-02T07:00:00", "x")],
                                "id string, operationTag string, createdAt string, file string")
    land_raw(raw, path, "CIMA1")
    out = land_raw(raw.where("false"), path, "CIMA1")
    assert out.count() == 1


def test_interrupted_swap_is_finished_next_run(spark):
    from herdflow.sinks.master import (_write_partitioned, mark_committed, recover_staged, read_table,
                                       with_partition)
    path = scratch_path(spark, "t-master")
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 1.0, t1)]), path)
    # a completed stage left behind by a run that stopped before swapping it in
    _write_partitioned(with_partition(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 9.0, t2)])),
                       f"{path}/_staging/crashed")
    mark_committed(spark, f"{path}/_staging/crashed")
    _write_partitioned(with_partition(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 5.0, t2)])),
                       f"{path}/_staging/unfinished")       # never marked: discarded
    assert recover_staged(spark, path)
    assert [r["weight_kg"] for r in read_table(spark, path).collect()] == [9.0]
    assert not recover_staged(spark, path)


def _wide(spark, rows):
    return spark.createDataFrame(rows, "date date, ear_tag string, device string, time string, weight_kg double, "
                                       "loaded_at timestamp, note string")


def test_new_columns_stay(spark):
    from herdflow.sinks.master import read_table
    path = scratch_path(spark, "t-master")
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    upsert_latest(_df(spark, [(dt.date(2024, 1, d), "1", "A", "07:00", 1.0, t1) for d in (5, 6)]), path)
    upsert_latest(_wide(spark, [(dt.date(2024, 1, 6), "1", "A", "07:00", 2.0, t2, "seen twice")]), path)
    got = {(r["date"].day, r["weight_kg"], r["note"]) for r in read_table(spark, path).collect()}
    assert got == {(5, 1.0, None), (6, 2.0, "seen twice")}


def test_dry_run_leaves_stages_alone(spark):
    from herdflow.sinks.master import _write_partitioned, mark_committed, read_table, with_partition
    path = scratch_path(spark, "t-master")
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 1.0, t1)]), path)
    for name in ("done", "open"):
        _write_partitioned(with_partition(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 9.0, t2)])), f"{path}/_staging/{name}")
    mark_committed(spark, f"{path}/_staging/done")
    before = sorted(os.listdir(path.removeprefix("file:") + "/_staging"))
    out = upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "2", "A", "07:00", 3.0, t2)]), path, write=False)
    assert {r["weight_kg"] for r in out.collect()} == {1.0, 3.0}
    assert sorted(os.listdir(path.removeprefix("file:") + "/_staging")) == before
    assert [r["weight_kg"] for r in read_table(spark, path).collect()] == [1.0]


def test_first_load_that_stopped_and_empty_first_batch(spark):
    from herdflow.sinks.master import _write_partitioned, with_partition
    path = scratch_path(spark, "t-master")
    t1 = dt.datetime(2024, 2, 1)
    assert upsert_latest(_df(spark, []), path).count() == 0
    _write_partitioned(with_partition(_df(spark, [(dt.date(2024, 1, 5), "9", "A", "07:00", 9.0, t1)])), f"{path}/_staging/open")
    out = upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 1.0, t1)]), path)
    assert [r["ear_tag"] for r in out.collect()] == ["1"]


def test_second_writer_is_refused(spark):
    from herdflow.sinks.master import read_table, writing
    path = scratch_path(spark, "t-master")
    t1 = dt.datetime(2024, 2, 1)
    upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "1", "A", "07:00", 1.0, t1)]), path)
    with writing(spark, path), pytest.raises(RuntimeError, match="another run"):
        upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "2", "A", "07:00", 1.0, t1)]), path)
    assert read_table(spark, path).count() == 1
    assert upsert_latest(_df(spark, [(dt.date(2024, 1, 5), "2", "A", "07:00", 1.0, t1)]), path).count() == 2


def test_keys_must_hold_the_date(spark):
    with pytest.raises(ValueError, match="date"):
        upsert_latest(_df(spark, []), scratch_path(spark, "t-master"), keys=["ear_tag"])


def test_ties_don_t_depend_on_row_order(spark):
    t1 = dt.datetime(2024, 2, 1)
    rows = [(dt.date(2024, 1, 5), "1", "A", "07:00", 1.0, t1, n) for n in ("b", "a", "c")]
    kept = {upsert_latest(_wide(spark, r), scratch_path(spark, "t-master")).first()["note"] for r in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert len(kept) == 1


def test_files_per_day_are_bounded(spark):
    path = scratch_path(spark, "t-master")
    t1 = dt.datetime(2024, 2, 1)
    rows = [(dt.date(2024, 1, 1 + i % 20), str(i), "A", "07:00", 1.0, t1) for i in range(2000)]
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        upsert_latest(_df(spark, rows).repartition(64), path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    n = sum(f.endswith(".parquet") for _, _, fs in os.walk(path.removeprefix("file:")) for f in fs)
    assert n <= 2 * 20


def test_raw_record_that_moved_to_another_day(spark):
    from herdflow.sinks.landing import land_raw, landing_outcomes
    path = scratch_path(spark, "t-landing")
    schema = "id string, operationTag string, createdAt string, file string"
    first = spark.createDataFrame([("1", "OP1", "2024-05-02T07:00:00", "x"), ("2", "OP1", "2024-05-02T08:00:00", "y"),
                                   ("3", None, None, "z")], schema)
    again = spark.createDataFrame([("1", "OP1", "2024-05-04T07:00:00", "new"), ("4", "OP2", "2024-05-04T07:00:00", "w"),
                                   ("3", None, None, "z")], schema)
    assert {r["outcome"] for r in landing_outcomes(first, path, "CIMA1").collect()} == {"written"}
    land_raw(first, path, "CIMA1")
    got = {r["bucket"]: (r["n_rows"], r["n_new"], r["n_landed"], r["outcome"]) for r in landing_outcomes(again, path, "CIMA1").collect()}
    assert got == {"OP1": (1, 0, 1, "skipped"), "OP2": (1, 1, 0, "written"), "direct_unknown": (1, 0, 1, "skipped")}
    assert land_raw(again, path, "CIMA1", write=False).count() >= 1
    out = land_raw(again, path, "CIMA1")
    assert sorted((r["id"], r["file"], str(r["file_date"])) for r in out.collect()) == [
        ("1", "new", "2024-05-04"), ("2", "y", "2024-05-02"), ("3", "z", "None"), ("4", "w", "2024-05-04")]
    assert land_raw(again, path, "CIMA2").where("device = 'CIMA2'").count() == 3


def test_sessions_landed_twice(spark):
    from herdflow.sinks.landing import land_sessions
    root = scratch_path(spark, "t-sess")
    sessions = spark.createDataFrame([("/s/1", "A", "2024-05-01T07:00:00", 1), ("/s/2", "B", "2024-05-02T07:00:00", 0)],
                                     "href string, name string, createdAt string, animalCount bigint")
    animals = spark.createDataFrame([(1, "A", "2024-05-01", "07:00", "5", 100.0, "")],
                                    "session_id int, session_name string, date string, time string, ear_tag string, "
                                    "weight double, scan_date string")
    dry = land_sessions(sessions, animals, root, write=False)
    assert [d.count() for d in dry] == [2, 1] and not os.path.exists(root.removeprefix("file:"))
    for _ in range(2):
        out = land_sessions(sessions, animals, root)
    assert [d.count() for d in out] == [2, 1]
