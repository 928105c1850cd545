"""The last row of an id over several triggers, late rows kept apart, replays."""
import datetime as dt

from herdflow.session import scratch_path
from herdflow.streaming.last import last_per_id, read_last
from herdflow.streaming.streams import ingest_stream

SCHEMA = "id string, ts timestamp, v int"


def _t(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _run(spark, root, ck="ck"):
    s = ingest_stream(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema).select("id", "ts", "v")
    last_per_id(s, ["id"], "ts", f"{root}/last", f"{root}/late", f"{root}/{ck}", "7 days").awaitTermination()


def _last(spark, root):
    return sorted(((r["id"], r["v"]) for r in read_last(spark, f"{root}/last", ["id"], "ts").collect()), key=str)


def _late(spark, root):
    df = spark.read.schema("id string, ts timestamp, v int, epoch bigint").parquet(f"{root}/late")
    return sorted((str(r["id"]), r["v"]) for r in df.collect())


def test_corrections_in_time_and_late(spark):
    root = scratch_path(spark, "t-last")
    lands = [[("a", _t(1), 1), ("a", _t(2), 2), ("b", _t(20), 3), (None, _t(20), 4), ("x", None, 9)],
             [("a", _t(15), 5), ("b", _t(20), 6), ("b", _t(19), 7), (None, _t(21), 8), ("late", _t(12), 10), ("in", _t(13), 11)],
             [("b", _t(18), 12), ("c", _t(30), 13), ("a", _t(13), 14)]]
    for rows in lands:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        _run(spark, root)
    want = [("a", 5), ("b", 6), ("c", 13), ("in", 11), (None, 8)]
    assert _last(spark, root) == sorted(want, key=str)
    assert _late(spark, root) == [("a", 14), ("late", 10), ("x", 9)]
    _run(spark, root)                                # nothing new: nothing changes
    assert _last(spark, root) == sorted(want, key=str) and len(_late(spark, root)) == 3


def test_hot_id_and_no_rows(spark):
    root = scratch_path(spark, "t-hot")
    spark.createDataFrame([("hot", _t(1 + i % 20), i) for i in range(3000)], SCHEMA).repartition(6).write.parquet(f"{root}/in")
    _run(spark, root)
    assert _last(spark, root) == [("hot", 2999)]
    assert spark.read.parquet(f"{root}/last").count() <= 6
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(f"{root}/in")
    _run(spark, root)
    assert _last(spark, root) == [("hot", 2999)]
