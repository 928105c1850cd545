"""Whole runs: checks, counts, modes, status rows and the daily fallback."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from herdflow.plans.reports import daily_report
from herdflow.plans.runs import Run, blob_run_full, daily, month_bundle, run_steps, session_run_full
from herdflow.session import scratch_path

DAY = dt.date(2022, 9, 10)
LOADED = "2022-09-11 04:30:00"


@pytest.fixture()
def herd(spark):
    return spark.createDataFrame([(DAY, "88", "370", "Dry", 1405, 61, 3)],
                                 "date date, no string, transp_2 string, group_name string, age_days int, dim int, lac_no int")


def _raw(spark, *lines, op="EVE"):
    return spark.createDataFrame([("1", op, "2022-09-10T18:00:00", "\n".join(lines))],
                                 "id string, operationTag string, createdAt string, file string")


def test_blob_run_counts_and_modes(spark, herd):
    landing, master = scratch_path(spark, "t-l"), scratch_path(spark, "t-m")
    raw = {"CIMA1": _raw(spark, "1; 400;TR:370;10/09/2022;18:00;S", "2; 5000;TR:371;10/09/2022;18:01;S", "3; 90;TR:;10/09/2022;18:02;S"),
           "CIMA2": _raw(spark, "1; 300;TR:5;10/09/2022;18:00;S")}
    empty = {k: v.where(F.lit(False)) for k, v in raw.items()}
    assert blob_run_full(spark, empty, landing, master, LOADED, DAY).status == "no_new_data"
    assert blob_run_full(spark, raw, landing, master, LOADED, DAY, "land").status == "landed"
    run = blob_run_full(spark, {}, landing, master, LOADED, DAY, "replay", enabled=["CIMA1"], snapshots=herd)
    assert (run.status, run.herd, run.counts["rows"], run.counts["matched"], run.counts["outside_range"]) == ("completed", "db_latest", 2, 1, 1)
    assert [r["ear_tag"] for r in run.table.collect()] == ["370"]
    full = blob_run_full(spark, raw, landing, master, LOADED, DAY, snapshots=herd, today_herd=herd)
    assert full.herd == "xls_today" and full.table.count() == 2
    before = full.table.count()
    dry = blob_run_full(spark, {"CIMA1": _raw(spark, "9; 410;TR:9;10/09/2022;19:00;S")}, landing, master, LOADED, DAY, write=False)
    assert dry.table.count() == before + 1 and spark.read.parquet(master).count() == before
    with pytest.raises(ValueError, match="mode"):
        blob_run_full(spark, raw, landing, master, LOADED, DAY, "other")


def test_session_run_lands_once(spark, herd):
    root, master = scratch_path(spark, "t-s"), scratch_path(spark, "t-m")
    listing = spark.createDataFrame([("/s/7", "A", "2022-09-10T18:00:00"), ("/s/x", "B", "2022-09-10T18:00:00")],
                                    "href string, name string, createdAt string")
    docs = spark.createDataFrame([(7, "A", "2022-09-10T18:00:00", ([("370", 400.0, "")],))],
                                 "session_id bigint, name string, createdAt string, "
                                 "animals struct<values: array<struct<rfid: string, currentWeight: double, scanDate: string>>>")
    run = session_run_full(spark, listing, docs, root, master, LOADED, DAY, snapshots=herd)
    assert run.status == "completed" and [r["no"] for r in run.table.collect()] == ["88"]
    assert session_run_full(spark, listing, docs, root, master, LOADED, DAY).status == "no_new_data"
    again = session_run_full(spark, None, None, root, scratch_path(spark, "t-m"), LOADED, DAY, "replay", snapshots=herd)
    assert again.table.count() == 1


def test_steps_log_and_daily_choices(spark, herd):
    log = scratch_path(spark, "t-log")
    rows = run_steps(spark, [("a", "x", lambda: Run("no_new_data")), ("b", "y", lambda: 1 / 0)], log)
    assert {(r["job_name"], r["status"]) for r in rows.collect()} == {("a", "no_new_data"), ("b", "failed")}
    assert spark.read.parquet(log).count() == 2
    master = spark.createDataFrame([(DAY, "88", "370", "A", 400.0)], "date date, no string, ear_tag string, device string, weight_kg double")
    out, reports = daily(spark, [("a", "x", lambda: Run("no_new_data"))], lambda: master, herd, dt.date(2022, 9, 30))
    got = {r["job_name"]: r["status"] for r in out.collect()}
    assert got["export"] == "skipped" and got["freshness"] == "alert" and "month_report" in got


def _master(spark, rows):
    return spark.createDataFrame(rows, "date date, device string, ear_tag string, no string, group_name string, animal_type string, "
                                       "weight_kg double, age_month double, dim int, lac_no int")


def test_one_panel_when_no_class_has_weights(spark):
    m = _master(spark, [(DAY, "A", str(i), None, None, None, 100.0 + i, None, None, None) for i in range(5)])
    h = daily_report(m, DAY)["histogram"].collect()
    assert {r["animal_type"] for r in h} == {"all"} and sum(r["n"] for r in h) == 5


def test_month_bundle_dry_run(spark, herd):
    import os
    path = scratch_path(spark, "t-month")
    herd = herd.withColumn("age_month_fix", F.lit(46.2))
    m = _master(spark, [(DAY, "A", "370", "88", "Dry", "cow", 400.0, 46.0, 56, 3), (DAY, "A", "371", None, None, None, 900.0, None, None, None)])
    frames, name = month_bundle(m, herd, dt.date(2022, 9, 1), dt.date(2022, 9, 30), path, raw={"ptm": m}, produced_at="x", write=False)
    assert not os.path.exists(path.removeprefix("file:")) and name == "clean_re_outlier"
    assert {r["stage"]: r["n"] for r in frames["stage_counts"].collect()} == {"raw_ptm": 2, "clean_csv": 2, "clean_re_outlier": 1}


def _weigh(spark, rows):
    import datetime as dt
    day = dt.date(2024, 5, 3)
    return spark.createDataFrame([("PTM", "CIMA1", day, "07:00", tag, w) for tag, w in rows],
                                 "source string, device string, date date, time string, ear_tag string, weight double")


def _herd(spark, n):
    import datetime as dt
    return spark.createDataFrame([(str(i), str(1000 + i), "g", 900, 30, 2, dt.date(2024, 5, 1)) for i in range(n)],
                                 "transp_2 string, no string, group_name string, age_days int, dim int, lac_no int, date date")


def test_gate_sees_the_rows_after_the_merge(spark):
    """40 rows, 10 with an animal; the 30 others fall to the range filter, after the gate."""
    from herdflow.operators.quality import join_rate_gate
    from herdflow.plans.runs import finish_rows
    from herdflow.session import scratch_path
    rows = _weigh(spark, [(str(i + 1), 400.0) for i in range(10)] + [(f"x{i}", 5000.0) for i in range(30)])
    run = finish_rows(rows, _herd(spark, 11), "db_latest", "2024-06-01 06:00:00", scratch_path(spark, "t-gate"))
    assert (run.status, run.join_rate, run.days) == ("completed", "alert", ["2024-05-03"])
    assert {k: run.counts[k] for k in ("rows", "matched", "outside_range", "new", "master")} == {
        "rows": 40, "matched": 10, "outside_range": 30, "new": 10, "master": 10}
    assert join_rate_gate(run.table, min_rows=1).first()["status"] == "ok"


def test_nothing_left_after_cleaning_fails_and_dry_run_counts(spark):
    from herdflow.plans.runs import finish_rows
    from herdflow.session import path_exists, scratch_path
    path = scratch_path(spark, "t-fail")
    run = finish_rows(_weigh(spark, [("", 400.0), ("nan", 400.0), (None, 1.0)]), _herd(spark, 2), "none", "2024-06-01 06:00:00", path)
    assert run.status == "failed" and run.counts["rows"] == 0 and run.table.count() == 0
    dry_path = scratch_path(spark, "t-dry")
    dry = finish_rows(_weigh(spark, [("1", 400.0), ("7", 30.0)]), _herd(spark, 2), "none", "2024-06-01 06:00:00", dry_path, write=False)
    assert (dry.status, dry.counts["rows"], dry.counts["matched"], dry.counts["new"]) == ("completed", 2, 1, 1)
    assert not path_exists(spark, dry_path)


def test_stream_logs_each_batch_and_replays(spark):
    from herdflow.session import scratch_path
    from herdflow.sinks.master import read_table
    from herdflow.streaming.jobs import weigh_stream
    from herdflow.streaming.streams import ingest_stream
    root = scratch_path(spark, "t-wstream")
    kind = "id string, device string, operationTag string, createdAt string, file string"
    files = ["1; 400,5;TR:1;03/05/2024;07:00;S\n2; 30,0;TR:9;03/05/2024;07:01;S", "no lines here", "1; 410,0;TR:1;03/05/2024;06:00;S"]
    for i, text in enumerate(files):
        spark.createDataFrame([(str(i), "CIMA1", "op", "2024-05-03T08:00:00", text)], kind).coalesce(1).write.mode("append").parquet(f"{root}/in")
        s = ingest_stream(spark, f"{root}/in", spark.createDataFrame([], kind).schema, max_files_per_trigger=1)
        weigh_stream(s, f"{root}/master", f"{root}/ck", lambda: _herd(spark, 2), f"{root}/log").awaitTermination()
    log = {r["epoch"]: r for r in spark.read.parquet(f"{root}/log").collect()}
    assert [(r["status"], r["rows"], r["matched"], r["new"]) for _, r in sorted(log.items())] == [
        ("completed", 2, 1, 1), ("failed", 0, 0, 0), ("completed", 1, 1, 1)]
    got = [(r["ear_tag"], r["weight_kg"]) for r in read_table(spark, f"{root}/master").collect()]
    assert got == [("1", 410.0)]                 # the later file wins, though its line is earlier in the day
    s = ingest_stream(spark, f"{root}/in", spark.createDataFrame([], kind).schema, max_files_per_trigger=1)
    weigh_stream(s, f"{root}/master", f"{root}/ck2", lambda: _herd(spark, 2), f"{root}/log2").awaitTermination()
    assert [(r["ear_tag"], r["weight_kg"]) for r in read_table(spark, f"{root}/master").collect()] == got


def test_month_bundle_makes_the_months_rows_once(spark, herd):
    """All tables of a written bundle read the month's rows, and are those of the dry run."""
    from herdflow.operators.dedup import dedup_latest
    from herdflow.session import scratch_path
    day = dt.date(2022, 9, 3)
    kind = "date date, device string, ear_tag string, time string, no string, animal_type string, age_month double, weight_kg double, lac_no tinyint, dim smallint, group_name string, loaded_at string"
    rows = [(d, "CIMA1", str(i % 9), f"07:{i:02d}", str(i % 9), "heifer", 6.0, w, 0, None, "H", "x")
            for i, (d, w) in enumerate((day + dt.timedelta(days=i % 40), [150.0, None, 90.0][i % 3]) for i in range(60))]
    master = dedup_latest(spark.createDataFrame(rows, kind), ["date", "ear_tag", "device"])
    args = (herd.withColumn("age_month_fix", F.lit(6.0)), dt.date(2022, 9, 1), dt.date(2022, 9, 30))
    path = scratch_path(spark, "t-month")
    frames, name = month_bundle(master, *args, path, produced_at="x")
    dry, dry_name = month_bundle(master, *args, path, produced_at="x", write=False)
    assert name == dry_name and frames.keys() == dry.keys()
    for k in frames:
        assert sorted(map(str, frames[k].collect())) == sorted(map(str, dry[k].collect())), k
    for k in ("clean_csv", "clean_re_outlier", "summary", "groups", "headline", "stage_counts"):
        assert "row_number" not in frames[k]._jdf.queryExecution().optimizedPlan().toString(), k
    assert "row_number" in dry["clean_csv"]._jdf.queryExecution().optimizedPlan().toString()


def test_stream_query_lands_many_files_a_trigger(spark, tmp_path, monkeypatch):
    """A landing comes in as many files as there are tasks, all in one batch, and gives the same master as the batch form."""
    from herdflow.harness import analogs as A
    from herdflow.harness import incremental
    from herdflow.session import path_exists
    monkeypatch.setattr(incremental, "scratch_path", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = incremental.q_weigh_stream(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    root = tmp_path / "stream"
    assert all(len(list((root / "in" / f"landing-{i}").glob("*.parquet"))) > 1 for i in range(3))
    assert path_exists(spark, str(root / "log0")) and spark.read.parquet(str(root / "log0")).count() == 3
    assert [spark.read.parquet(str(root / f"log1-{i}")).count() for i in range(3)] == [1, 1, 1]
    want = A.master(spark, "/root/testdata/sf0.001").drop("loaded_at")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_profile_change_by_value(spark):
    """Each number by plain Python, for columns of several types; no aggregate over copies of the rows for each distinct count."""
    from herdflow.operators.quality import profile_change
    values = [None, " NaN ", "nan", "1", "01", "001", "2", "02", "x", "", "1"]
    data = [(v, i % 4 if i % 5 else None, float("nan") if i == 3 else float(i % 3)) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "t string, `a.b` int, f double").repartition(3)
    after = {"t": F.expr("try_cast(t AS int)").cast("string"), "a.b": F.when(F.col("`a.b`") < 3, F.col("`a.b`").cast("long")), "f": F.when(F.col("f") > 0, F.lit(1.0))}
    out = profile_change(df, after)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    as_int = lambda v: str(int(v)) if v and v.strip().isdigit() else None
    same = lambda v: "nan" if isinstance(v, float) and v != v else v
    pairs = {"t": [(t, as_int(t)) for t, _, _ in data], "a.b": [(i, i if i is not None and i < 3 else None) for _, i, _ in data],
             "f": [(same(f), 1.0 if f != f or f > 0 else None) for _, _, f in data]}
    found = {r["column"]: r for r in out.collect()}
    for c, ps in pairs.items():
        text = lambda v: v is not None and str(v).strip().lower() == "nan"
        want = {"nulls_before": sum(b is None for b, _ in ps), "nulls_after": sum(a is None for _, a in ps),
                "nan_text_before": sum(text(b) for b, _ in ps), "nan_text_after": sum(text(a) for _, a in ps), "n_changed": sum(b != a for b, a in ps),
                "n_newly_null": sum(b is not None and a is None for b, a in ps),
                "distinct_before": len({b for b, _ in ps if b is not None}), "distinct_after": len({a for _, a in ps if a is not None}),
                "n_newly_equal": len({b for b, a in ps if b is not None and a is not None}) - len({a for b, a in ps if b is not None and a is not None})}
        assert {k: found[c][k] for k in want} == want, c
    empty = {r["column"]: r for r in profile_change(df.limit(0), after).collect()}
    assert set(empty) == set(after) and all(v == 0 for r in empty.values() for k, v in r.asDict().items() if k != "column")
