"""Structured Streaming forms of the incremental behaviour: file ingest, id dedup with
lateness, streaming upsert and daily counts. Checkpoints live in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from herdflow.operators.dedup import dedup_latest
from herdflow.sinks.master import upsert_latest


FILE_TIME = "_file_time"


def ingest_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Each landed file is read exactly once (the file source remembers it in the checkpoint).
    `FILE_TIME` is the time the row's file was written."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).withColumn(FILE_TIME, F.col("_metadata.file_modification_time"))


def event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): cast in the session time zone."""
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def dedup_stream(df: DataFrame, id_cols: list[str], ts_col: str, lateness: str = "7 days") -> DataFrame:
    """Drop repeated ids within the lateness window; rows later than the watermark are dropped."""
    return event_time(df, ts_col).withWatermark(ts_col, lateness).dropDuplicatesWithinWatermark(id_cols)


def daily_counts_stream(df: DataFrame, ts_col: str, by: list[str], lateness: str = "7 days") -> DataFrame:
    """Rows per (day window, by...) maintained as data arrives."""
    d = event_time(df, ts_col).withWatermark(ts_col, lateness)
    return (d.groupBy(F.window(F.col(ts_col), "1 day").alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("date").alias("day"), *by, "n"))


def versioned_batch_writer(path: str):
    """foreachBatch body for an update-mode aggregate: the updated rows of micro-batch N
    go to partition ``epoch=N`` (dynamic overwrite, so a replayed batch rewrites only its
    own partition). Nothing is read back or rewritten, so a crash at any point leaves the
    table consistent; `read_latest` gives the current value per key."""
    def _fn(batch: DataFrame, epoch: int) -> None:
        (batch.withColumn("epoch", F.lit(epoch).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch").parquet(path))
    return _fn


def read_latest(spark, path: str, keys: list[str]) -> DataFrame:
    """Current value per key of a `versioned_batch_writer` table (newest epoch wins)."""
    df = spark.read.parquet(path)
    return dedup_latest(df, keys, [F.col("epoch").desc()]).drop("epoch")


def upsert_stream(df: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None,
                  file_time: str = FILE_TIME) -> StreamingQuery:
    """Streaming master upsert: every micro-batch goes through `upsert_latest`.

    ``loaded_at`` is the time the row's file was written (`file_time`, where the stream
    carries it), so a replayed batch gives the same rows, a new checkpoint doesn't start
    again from an old time, and rows of a later file win over rows that a batch job loaded
    before. A null file time leaves the row's own ``loaded_at``.
    """
    def _batch(batch: DataFrame, epoch: int) -> None:
        b = batch
        if file_time in b.columns:
            own = F.col("loaded_at") if "loaded_at" in b.columns else F.lit(None)
            kind = b.schema["loaded_at"].dataType if "loaded_at" in b.columns else T.TimestampType()
            b = b.withColumn("loaded_at", F.coalesce(F.col(file_time).cast(kind), own)).drop(file_time)
        if keys is None:
            upsert_latest(b, path)
        else:
            upsert_latest(b, path, keys)
    return (df.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_available(df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet") -> None:
    """Process everything available now into a file sink and wait for it."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .option("path", sink_path).trigger(availableNow=True).start())
    q.awaitTermination()
