"""The blob job as a stream: landed files come in, the master and a log of counts go out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from herdflow.plans.jobs import blob_rows
from herdflow.plans.runs import finish_rows
from herdflow.sources.snapshots import resolve_herd
from herdflow.streaming.streams import FILE_TIME

COUNTS = ("rows", "matched", "outside_range", "new", "master")
LOG_SCHEMA = "status string, join_rate string, herd string, " + ", ".join(f"{c} bigint" for c in COUNTS)


def weigh_stream(blobs: DataFrame, master_path: str, checkpoint: str, snapshots: Callable[[], DataFrame | None],
                 log_path: str | None = None, source: str = "PTM", as_of=None, file_time: str = FILE_TIME) -> StreamingQuery:
    """Every micro-batch of landed blobs is parsed, joined to the herd, checked and upserted (`finish_rows`).

    `snapshots` is asked once a batch, so a batch sees the snapshot that is there when it runs. ``loaded_at`` is the
    time of the batch's newest file: a replayed batch gives the same rows again and changes nothing, and a later file
    wins over an earlier one. The log has a partition a batch, which a replay overwrites; a batch without rows after
    cleaning is logged as ``failed`` and leaves the master as it is.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        newest = batch.agg(F.max(file_time).alias("t")).first()["t"]
        if newest is None:
            return
        herd, label = resolve_herd(None, snapshots(), as_of)
        done = finish_rows(blob_rows(batch.drop(file_time), source), herd, label, newest, master_path)
        if log_path is not None:
            row = (done.status, done.join_rate, done.herd, *[done.counts.get(c) for c in COUNTS])
            (batch.sparkSession.createDataFrame([row], LOG_SCHEMA).withColumn("epoch", F.lit(epoch).cast("bigint"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(log_path))

    return (blobs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
