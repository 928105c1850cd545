"""Sources and sinks around the master, quality checks and composed jobs."""
import datetime as dt
import os

import pytest

from herdflow.operators.conform import observe_range
from herdflow.operators.quality import (expect_columns, expect_non_empty, join_rate_gate, preview,
                                        probe, summary)
from herdflow.plans.jobs import blob_run, daily_run
from herdflow.plans.reports import daily_report, month_report, weekly_report
from herdflow.session import local_path, scratch_path
from herdflow.sinks.landing import land_sessions
from herdflow.sinks.master import append_run_log, export_csv, upsert_latest, write_month_bundle
from herdflow.sources.blobs import read_raw_csv
from herdflow.sources.master import read_master
from herdflow.sources.snapshots import apply_header_mapping, resolve_herd

MASTER = ("source string, device string, date date, time string, no string, ear_tag string, "
          "group_name string, animal_type string, weight_kg double, age_month double, age_days smallint, "
          "dim smallint, lac_no tinyint, loaded_at timestamp")


def _master_rows(spark):
    t = dt.datetime(2024, 6, 1)
    d = [dt.date(2024, 5, 2), dt.date(2024, 5, 20), dt.date(2024, 4, 30)]
    return spark.createDataFrame([
        ("PTM", "CIMA1", d[0], "07:00", "1", "11", "G1", "heifer", 200.0, 6.0, 183, None, 0, t),
        ("PTM", "CIMA1", d[0], "07:05", "2", "12", "G1", "cow", 450.0, 30.0, 913, 40, 2, t),
        ("PTM", "CIMA2", d[1], "08:00", "2", "12", "G2", "cow", 460.0, 30.5, 930, 58, 2, t),
        ("PTM", "CIMA2", d[2], "08:00", None, "13", None, "unknown", 90.0, None, None, None, None, t),
    ], MASTER)


def test_read_raw_csv_prunes_by_file_name(spark):
    root = local_path(scratch_path(spark, "t-raw"))
    os.makedirs(root)
    for name, op in [("raw_CIMA1_direct_2024-02-24.csv", ""), ("raw_CIMA1_012-12032024_00.csv", "OP1"),
                     ("raw_CIMA1_nodate.csv", "OP2"), ("_raw_CIMA1_direct_2024-02-25.csv", "HIDDEN")]:
        with open(os.path.join(root, name), "w") as fh:
            fh.write('id,operationTag,createdAt,file\n1,%s,2024-02-24T07:00:00,"1; 5,0;TR:1;24/02/2024;07:00;S\n2; 6,0;TR:2;24/02/2024;07:01;S"\n' % op)
    df = read_raw_csv(spark, root, "2024-02-01", "2024-02-28")
    got = [(r["operationTag"], r["file_date"]) for r in df.collect()]
    assert got == [(None, dt.date(2024, 2, 24))]
    assert "\n" in df.first()["file"]
    assert read_raw_csv(spark, root).count() == 2


def test_read_master_prunes_months(spark):
    path = scratch_path(spark, "t-master")
    upsert_latest(_master_rows(spark), path)
    df = read_master(spark, path, "2024-05-01", "2024-05-31", weighed_only=True)
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_header_mapping_and_source_precedence(spark):
    raw = spark.createDataFrame([(" 0012.0 ", "9.82091074767472e+14", "G", "100", "x")],
                                "`Cow No ` string, `EarTag` string, `Group` string, `Age Days` string, junk string")
    out = apply_header_mapping(raw, {"EarTag": "Transponder"}, {"Cow No": "no", "Transponder": "transp_2",
                                                               "Group": "group_name", "Age Days": "age_days"},
                               ["Cow No", "Transponder"], dt.date(2024, 5, 1))
    r = out.first()
    assert out.columns == ["no", "transp_2", "group_name", "age_days", "date"]
    assert (r["no"], r["transp_2"], r["date"]) == ("12", "982091074767472", dt.date(2024, 5, 1))
    snaps = spark.createDataFrame([(dt.date(2024, 4, 1), "1", "5"), (dt.date(2024, 5, 1), "1", "5")],
                                  "date date, no string, transp_2 string")
    assert resolve_herd(out, snaps)[1] == "xls_today"
    assert resolve_herd(out.where("false"), snaps)[1] == "db_latest"
    df, label = resolve_herd(out, snaps, as_of=dt.date(2024, 4, 15))
    assert label == "db_snapshot" and [r["date"] for r in df.collect()] == [dt.date(2024, 4, 1)]
    assert resolve_herd(None, None) == (None, "none")


def test_exports_bundle_and_run_log(spark):
    m = _master_rows(spark)
    root = scratch_path(spark, "t-out")
    export_csv(m, f"{root}/csv", order=["date", "device", "ear_tag"])
    back = spark.read.option("header", True).csv(f"{root}/csv")
    assert back.count() == 4
    name = write_month_bundle({"clean_csv": m, "clean_re_outlier": m.where("false")}, f"{root}/bundle", "202405")
    assert name == "clean_csv"
    assert spark.read.parquet(f"{root}/bundle/month=202405/clean_csv").count() == 4
    append_run_log(spark, f"{root}/log", [("job", "CIMA1", "completed", 1.234, "a\nb")])
    log = append_run_log(spark, f"{root}/log", [("job", "CIMA2", "failed", None, "x")])
    assert log.first()["status"] == "failed"
    rows = spark.read.parquet(f"{root}/log").collect()
    assert len(rows) == 2 and {r["msg"] for r in rows} == {"a b", "x"}
    assert {r["duration"] for r in rows} == {1.23, None}


def test_land_sessions_keeps_empty_sessions(spark):
    root = scratch_path(spark, "t-sess")
    sessions = spark.createDataFrame([("1", "/s/1", "A", "2024-05-01T07:00:00", 2),
                                      ("2", "/s/2", "B", "2024-05-02T07:00:00", 0)],
                                     "id string, href string, name string, createdAt string, animalCount bigint")
    animals = spark.createDataFrame([(1, "A", "2024-05-01", "07:00", "5", 100.0, "")],
                                    "session_id int, session_name string, date string, time string, "
                                    "ear_tag string, weight double, scan_date string")
    land_sessions(sessions, animals, root)
    assert spark.read.parquet(f"{root}/sessions").count() == 2
    assert spark.read.parquet(f"{root}/animals").count() == 1


def test_quality_checks(spark):
    m = _master_rows(spark)
    assert expect_non_empty(m) and not expect_non_empty(m.where("false"))
    assert expect_columns(m, ["no", "zzz"]) == ["zzz"]
    assert summary(m).first()["n_cols"] == 14
    g = join_rate_gate(m).first()
    assert g["status"] == "skipped" and g["ok"]            # fewer than 20 rows
    big = m.unionByName(m).unionByName(m).unionByName(m).unionByName(m)
    g2 = join_rate_gate(big).first()
    assert (g2["total"], g2["matched"], g2["status"]) == (20, 15, "ok")
    assert join_rate_gate(m.drop("no")).first()["status"] == "skipped"
    p = probe(spark, {"ok": "/root/testdata/sf0.001/region.parquet", "missing": "/nonexistent/x.parquet"})
    got = {r["name"]: (r["n_rows"], r["error"] is None) for r in p.collect()}
    assert got == {"ok": (5, True), "missing": (None, False)}
    assert [r["ear_tag"] for r in preview(m, 2, ["date", "device", "ear_tag"], tail=True).collect()] == ["12", "12"]


def test_observe_range_counts_without_extra_pass(spark):
    m = _master_rows(spark)
    kept, obs = observe_range(m, "weight_kg", 100.0, 800.0)
    assert kept.count() == 3
    assert obs.get == {"n_in": 4, "n_kept": 3}


def test_reports(spark):
    m = _master_rows(spark)
    herd = spark.createDataFrame([(dt.date(2024, 5, 1), 6.0, 0, None), (dt.date(2024, 5, 1), None, 2, 40)],
                                 "date date, age_month_fix double, lac_no int, dim int")
    day = daily_report(m, dt.date(2024, 5, 2))
    c = day["counts"].first()
    assert (c["n_cow"], c["n_heifer"], c["n_total"]) == (1, 1, 2)
    assert day["heifer_curve"].count() == 1 and day["cow_curve"].count() == 1
    assert day["histogram"].count() == 40
    w = weekly_report(m, herd, dt.date(2024, 5, 24))
    assert {r["label"]: r["weighed"] for r in w["coverage"].collect()}["6 tháng"] == 1
    mr = month_report(m, herd, dt.date(2024, 5, 1), dt.date(2024, 5, 31), produced_at="x")
    assert mr["clean_csv"].count() == 3 and mr["headline"].first()["n_outliers"] == 0
    assert {r["label"]: r["weighed"] for r in mr["groups"].collect()}["All Lact Peak"] == 1
    assert {r["item"] for r in mr["meta"].collect()} == {"period", "threshold", "baseline_date", "produced_at"}


def test_daily_run_continues_after_failure(spark):
    def boom():
        raise RuntimeError("upstream down\nmore")
    def silent():
        raise ValueError
    st = {r["job"]: (r["status"], r["msg"]) for r in daily_run(spark, [("a", boom), ("s", silent), ("b", lambda: 1)]).collect()}
    assert st == {"a": ("failed", "upstream down\nmore"), "s": ("failed", "ValueError"), "b": ("completed", "")}


def test_blob_run_modes(spark):
    raw = spark.createDataFrame([("1", "OP1", "2024-05-02T07:00:00", "1; 500,0;TR:0011;02/05/2024;07:00;S"),
                                 ("2", "", "2024-05-03T07:00:00", "2; 510,0;TR:12;03/05/2024;07:00;S")],
                                "id string, operationTag string, createdAt string, file string")
    herd = spark.createDataFrame([(dt.date(2024, 5, 3), "7", "11", "G", 200, None, 0)],
                                 "date date, no string, transp_2 string, group_name string, age_days int, "
                                 "dim int, lac_no int")
    landing, master = scratch_path(spark, "t-landing"), scratch_path(spark, "t-master")
    landed = blob_run(spark, landing, "CIMA1", herd, "2024-06-01 00:00:00", master, raw=raw, mode="land")
    assert sorted(r["kind"] for r in landed.collect()) == ["direct", "operation"]
    out = blob_run(spark, landing, "CIMA1", herd, "2024-06-01 00:00:00", master, mode="replay",
                   date_from="2024-05-02", date_to="2024-05-02")
    rows = out.collect()
    assert [(r["ear_tag"], r["no"], r["animal_type"], r["age_days"]) for r in rows] == [("11", "7", "heifer", 199)]
    with pytest.raises(ValueError):
        blob_run(spark, landing, "CIMA1", herd, "2024-06-01 00:00:00", master, mode="bogus")
