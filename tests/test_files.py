"""File-level scans: windows by name or folder, unreadable files reported."""
import datetime as dt
import os

import pytest

from herdflow.session import local_path, scratch_path
from herdflow.sources.blobs import read_raw_csv, scan_raw_csv
from herdflow.sources.sessions import read_sessions, scan_sessions

BLOB = 'id,operationTag,createdAt,file\n1,%s,2024-02-24T07:00:00,"1; 5,0;TR:1;24/02/2024;07:00;S\n2; 6,0;TR:2;24/02/2024;07:01;S"\n'
SESSION = "session_id,session_name,date,time,ear_tag,weight,scan_date\n%s,n,%s,07:00,t1,400,\n"


@pytest.fixture
def root(spark):
    path = local_path(scratch_path(spark, "t-files"))
    os.makedirs(path)
    return path


def _put(root, name, text):
    os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
    with open(os.path.join(root, name), "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def _states(scan):
    return {r["name"]: (r["status"], list(r["missing"])) for r in scan.files.collect()}


def test_blobs_by_window_and_state(spark, root):
    _put(root, "raw_A_direct_2024-02-24.csv", BLOB % "in")
    _put(root, "raw_A_012-12032024_00.csv", BLOB % "late")
    _put(root, "raw_A_nodate.csv", BLOB % "undated")
    _put(root, "raw_A_direct_2024-02-25.csv", "")
    _put(root, "raw_A_direct_2024-02-26.csv", "id;operationTag\n1;x\n")
    _put(root, "raw_A_direct_2024-02-27.csv", "﻿\"id\",\"operationTag\",\"createdAt\",\"file\"\n1,bom,c,f\n")
    _put(root, "raw_A_direct_2024-02-28.csv", b"\x00\xff\xfe\x00")
    scan = scan_raw_csv(spark, root, "2024-02-01", "2024-02-28")
    assert _states(scan) == {
        "raw_A_direct_2024-02-24.csv": ("read", []), "raw_A_012-12032024_00.csv": ("outside", []), "raw_A_nodate.csv": ("undated", []),
        "raw_A_direct_2024-02-25.csv": ("empty", []), "raw_A_direct_2024-02-26.csv": ("unreadable", ["operationTag", "file"]),
        "raw_A_direct_2024-02-27.csv": ("read", []), "raw_A_direct_2024-02-28.csv": ("unreadable", ["operationTag", "file"])}
    got = sorted((r["operationTag"], r["file_date"], r["file"].count("\n")) for r in scan.rows.collect())
    assert got == [("bom", dt.date(2024, 2, 27), 0), ("in", dt.date(2024, 2, 24), 1)]


def test_files_outside_the_window_are_not_opened(spark, root):
    _put(root, "raw_A_direct_2024-02-24.csv", BLOB % "in")
    _put(root, "raw_A_direct_2023-02-24.csv", BLOB % "old")
    os.chmod(os.path.join(root, "raw_A_direct_2023-02-24.csv"), 0)
    scan = scan_raw_csv(spark, root, "2024-01-01")
    assert [f.rsplit("/", 1)[1] for f in scan.rows.inputFiles()] == ["raw_A_direct_2024-02-24.csv"]
    assert [r["operationTag"] for r in scan.rows.collect()] == ["in"]


def test_nothing_to_read(spark, root):
    _put(root, "raw_A_direct_2024-02-24.csv", "")
    scan = scan_raw_csv(spark, root)
    assert scan.rows.count() == 0 and "file_date" in scan.rows.columns and _states(scan)["raw_A_direct_2024-02-24.csv"][0] == "empty"
    assert read_raw_csv(spark, root, "2030-01-01").count() == 0


def test_sessions_flat_and_in_folders(spark, root):
    for i, day in enumerate(("2024-01-05", "2024-01-06", "2024-01-20")):
        _put(root, f"flat/{i}.csv", SESSION % (i, day))
        _put(root, f"days/date={day}/part-{i}.csv", "session_id,session_name,time,ear_tag,weight,scan_date\n%d,n,07:00,t1,400,\n" % i)
    _put(root, "flat/9.csv", "who,knows\n1,2\n")
    _put(root, "flat/_state.csv", SESSION % (8, "2024-01-05"))
    flat = scan_sessions(spark, f"{root}/flat", "2024-01-05", "2024-01-10")
    assert _states(flat)["9.csv"] == ("unreadable", ["session_id", "date", "ear_tag", "weight"]) and "_state.csv" not in _states(flat)
    days = scan_sessions(spark, f"{root}/days", "2024-01-05", "2024-01-10")
    assert sorted(x[0] for x in _states(days).values()) == ["outside", "read", "read"]
    want = [("0", "2024-01-05", None), ("1", "2024-01-06", None)]
    for scan in (flat, days):
        assert sorted((r["session_id"], r["date"], r["scan_date"]) for r in scan.rows.collect()) == want
    assert read_sessions(spark, f"{root}/flat").count() == 3
