"""Structured Streaming operators (ST1-ST4)."""
import datetime as dt

from pyspark.sql import functions as F

from herdflow.session import scratch_path
from herdflow.streaming.streams import dedup_stream, ingest_stream, run_available

SCHEMA = "id long, ts timestamp_ntz, v double"


def _land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)


def test_dedup_with_lateness(spark):
    root = scratch_path(spark, "t-stream")
    src, out, ck = f"{root}/in", f"{root}/out", f"{root}/ck"
    t = dt.datetime(2024, 1, 20)
    _land(spark, src, [(1, t, 1.0), (2, t, 2.0), (2, t, 2.0)])
    schema = spark.read.parquet(src).schema
    run_available(dedup_stream(ingest_stream(spark, src, schema), ["id"], "ts", "7 days"), out, ck)
    # second landing: a repeat inside the window, a new row, and a row later than the watermark
    _land(spark, src, [(1, t, 1.0), (3, t + dt.timedelta(days=1), 3.0), (4, t - dt.timedelta(days=30), 4.0)])
    run_available(dedup_stream(ingest_stream(spark, src, schema), ["id"], "ts", "7 days"), out, ck)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_each_file_read_once(spark):
    root = scratch_path(spark, "t-stream")
    src, out, ck = f"{root}/in", f"{root}/out", f"{root}/ck"
    t = dt.datetime(2024, 1, 20)
    _land(spark, src, [(1, t, 1.0)])
    schema = spark.read.parquet(src).schema
    for _ in range(2):
        run_available(ingest_stream(spark, src, schema).withColumn("n", F.lit(1)), out, ck)
    assert spark.read.parquet(out).count() == 1


def test_daily_counts_update_mode_versioned_sink(spark):
    from herdflow.streaming.streams import daily_counts_stream, read_latest, versioned_batch_writer
    root = scratch_path(spark, "t-stream")
    src, out, ck = f"{root}/in", f"{root}/out", f"{root}/ck"
    day = dt.datetime(2024, 1, 20, 10)
    _land(spark, src, [(1, day, 1.0), (2, day, 1.0)])
    schema = spark.read.parquet(src).schema
    for rows in ([], [(3, day, 1.0), (4, day + dt.timedelta(days=1), 1.0)]):
        if rows:
            _land(spark, src, rows)
        counts = daily_counts_stream(ingest_stream(spark, src, schema).withColumn("k", F.lit("a")), "ts", ["k"])
        (counts.writeStream.outputMode("update").foreachBatch(versioned_batch_writer(out))
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    got = {(r["day"], r["n"]) for r in read_latest(spark, out, ["day", "k"]).collect()}
    assert got == {(dt.date(2024, 1, 20), 3), (dt.date(2024, 1, 21), 1)}


def test_upsert_stream_keeps_latest_and_rerun_is_noop(spark):
    from herdflow.sinks.master import read_table
    from herdflow.streaming.streams import FILE_TIME, upsert_stream
    root = scratch_path(spark, "t-stream")
    src, master, ck = f"{root}/in", f"{root}/master", f"{root}/ck"
    day = dt.datetime(2024, 1, 20, 7)
    schema = "id long, ts timestamp_ntz, v double"

    def rows(s):
        return s.select(F.lit("A").alias("device"), F.to_date("ts").alias("date"),
                        F.date_format("ts", "HH:mm").alias("time"), F.col("id").cast("string").alias("ear_tag"),
                        F.col("v").alias("weight_kg"), FILE_TIME)
    _land(spark, src, [(1, day, 100.0), (2, day, 200.0)])
    upsert_stream(rows(ingest_stream(spark, src, spark.read.parquet(src).schema)), master, ck).awaitTermination()
    _land(spark, src, [(1, day, 150.0)])                     # later batch wins for tag 1
    for _ in range(2):                                        # second run finds nothing new
        upsert_stream(rows(ingest_stream(spark, src, spark.read.parquet(src).schema)), master, ck).awaitTermination()
    got = {r["ear_tag"]: r["weight_kg"] for r in read_table(spark, master).collect()}
    assert got == {"1": 150.0, "2": 200.0}
