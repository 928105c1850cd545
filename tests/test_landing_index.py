"""Landing by an index of ids: only the partitions that hold a batch's ids are read."""
import glob
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.session import local_path, scratch_path
from herdflow.sinks import id_index
from herdflow.sinks.landing import land_raw, landed_in, replace_by_id

RAW = "id string, operationTag string, createdAt string, file string"


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def _day(n):
    return f"2024-01-{n:02d}T08:00:00"


def _files(path, day):
    return sorted(glob.glob(f"{local_path(path)}/device=A/file_date={day}/*.parquet"))


def _landed(spark, rows):
    path = scratch_path(spark, "t-landing")
    land_raw(_raw(spark, rows), path, "A")
    return path


def test_other_days_are_not_opened(spark):
    """Files of days without the batch's ids are spoiled; landing goes on without them."""
    path = _landed(spark, [(str(i), f"op{i}", _day(i % 9 + 1), "x") for i in range(90)])
    for day in range(3, 10):
        for f in _files(path, f"2024-01-{day:02d}"):
            os.chmod(f, 0o644)
            with open(f, "wb") as out:
                out.write(b"not parquet")
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.truncate(crc, 0)
    land_raw(_raw(spark, [("0", "op0", _day(2), "moved"), ("1", "op1", _day(2), "again"), ("n", "new", _day(2), "new")]), path, "A")
    found = spark.read.parquet(f"{path}/device=A").where(F.col("file_date").isin("2024-01-01", "2024-01-02"))
    got = {r["id"]: (str(r["file_date"]), r["file"]) for r in found.collect()}
    assert got["0"] == ("2024-01-02", "moved") and got["1"] == ("2024-01-02", "again") and got["n"][1] == "new"
    assert len(got) == 21


def test_plan_reads_only_the_touched_partitions(spark):
    path = _landed(spark, [(str(i), f"op{i}", _day(i % 9 + 1), "x") for i in range(90)])
    batch = land_raw(_raw(spark, [("0", "op0", _day(5), "y")]), path, "A", write=False)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("file_date" in f and "IN" in f for f in filters)
    assert {str(r["file_date"]) for r in batch.select("file_date").distinct().collect()} == {"2024-01-01", "2024-01-05"}


def test_moved_ids_null_days_and_names(spark):
    path = _landed(spark, [("1", "op", _day(1), "a"), ("2", "op", None, "b"), ("3", "", _day(1), "c"), (None, "op", _day(2), "d")])
    batch = _raw(spark, [("2", "op", _day(3), "b2"), (None, "op", None, "d2")])
    assert {(str(r["file_date"]), r["n_ids"]) for r in landed_in(batch, path, "A").collect()} == {("None", 1), ("2024-01-02", 1)}
    out = land_raw(batch, path, "A")
    got = sorted((str(r["id"]), str(r["file_date"]), r["file"]) for r in out.collect())
    assert got == [("1", "2024-01-01", "a"), ("2", "2024-01-03", "b2"), ("3", "2024-01-01", "c"), ("None", "None", "d2")]


def test_table_without_index_and_new_columns(spark):
    """A table landed before there was an index gets one; columns of either side stay."""
    path = scratch_path(spark, "t-old")
    kind = T.StringType()
    spark.createDataFrame([("1", "a", "x"), ("2", "b", "x")], "id string, v string, part string").write.partitionBy("part").parquet(path)
    assert not id_index.ready(spark, path)
    new = spark.createDataFrame([("1", 5, "y")], "id string, w int, part string")
    assert sorted(r["id"] for r in replace_by_id(new, path, "part", kind, ["id"], write=False).collect()) == ["1", "2"]
    out = replace_by_id(new, path, "part", kind, ["id"])
    assert id_index.ready(spark, path)
    assert sorted((r["id"], r["v"], r["w"], r["part"]) for r in out.collect()) == [("1", None, 5, "y"), ("2", "b", None, "x")]
    assert sorted((r["part"], r["n_ids"]) for r in id_index.lookup(spark, path, id_index.entries(new, ["id"], "part")).collect()) == [
        ("x", 1), ("y", 1)]                # the old place is named too many, never too few


def test_index_stays_small(spark, monkeypatch):
    monkeypatch.setattr(id_index, "MOST_RUNS", 3)
    path = scratch_path(spark, "t-many")
    for i in range(7):
        replace_by_id(spark.createDataFrame([(str(i), "p"), ("same", "p")], "id string, part string"), path, "part", T.StringType(), ["id"])
        assert len(id_index.runs(spark, path)) <= 4
    assert id_index.read(spark, path).select("h", "part").distinct().count() == 8
    assert spark.read.parquet(path).count() == 8


def test_nothing_new_writes_no_partition(spark):
    path = _landed(spark, [("1", "op", _day(1), "a")])
    before = _files(path, "2024-01-01")
    land_raw(_raw(spark, []), path, "A")
    assert _files(path, "2024-01-01") == before


@pytest.mark.parametrize("text", ["", "{\"type\": \"str"])
def test_schema_file_written_half(spark, text):
    path = _landed(spark, [("1", "op", _day(1), "a")])
    with open(f"{local_path(path)}/device=A/_schema.json", "w") as f:
        f.write(text)
    crc = f"{local_path(path)}/device=A/._schema.json.crc"
    if os.path.exists(crc):
        os.remove(crc)
    out = land_raw(_raw(spark, [("1", "op", _day(1), "b")]), path, "A")
    assert [r["file"] for r in out.collect()] == ["b"]
