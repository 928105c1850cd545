"""The last row of an id in a stream, and the rows that come too late for it.

No keyed state is held: every micro-batch writes its newest row of each id under its own number, with the newest
time it has seen beside them, and the current row of an id is picked when the table is read. (Spark's state with a
timeout either drops late rows unseen or, by the clock, never lets an `availableNow` run end.)
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from herdflow.operators.dedup import dedup_latest
from herdflow.session import path_exists
from herdflow.streaming.streams import versioned_batch_writer

MARKS = "_marks"


def newest_first(df: DataFrame, id_cols: list[str], ts_col: str) -> list[Column]:
    """The later time first; rows of equal time in one batch by all their other columns, so a replay picks the same."""
    rest = sorted(f.name for f in df.schema.fields if f.name not in (*id_cols, ts_col, "epoch") and isinstance(f.dataType, T.AtomicType))
    return [F.col(ts_col).desc_nulls_last(), *[F.col("epoch").desc()] * ("epoch" in df.columns), *[F.col(c).desc_nulls_last() for c in rest]]


def watermark(spark: SparkSession, path: str, epoch: int, lateness: str):
    """The newest time of the batches before `epoch`, less the lateness; None at the start."""
    if not path_exists(spark, f"{path}/{MARKS}"):
        return None
    row = spark.read.parquet(f"{path}/{MARKS}").where(F.col("epoch") < epoch).agg(F.max("newest").alias("t")).first()
    return None if row["t"] is None else row["t"] - pd.Timedelta(lateness).to_pytimedelta()


def last_per_id(df: DataFrame, id_cols: list[str], ts_col: str, path: str, late_path: str, checkpoint: str,
                lateness: str = "7 days") -> StreamingQuery:
    """Keep the last row of each id of a stream under `path` (`read_last` reads it), late rows under `late_path`.

    A row replaces an id's row if its time is the same or later; a correction that is sent again with the same time wins
    if it comes in a later batch. A row older than the watermark of the batches before, or without a time, is late: it
    changes nothing and is kept apart. Null ids are one id. Each batch keeps a row an id before its shuffle, so a hot
    id costs a row a task; each partition of the tables is a batch's, and a replay overwrites its own.
    """
    last, late, marks = versioned_batch_writer(path), versioned_batch_writer(late_path), versioned_batch_writer(f"{path}/{MARKS}")

    def write(batch: DataFrame, epoch: int) -> None:
        mark = watermark(batch.sparkSession, path, epoch, lateness)
        ts = F.col(ts_col)
        in_time = ts.isNotNull() if mark is None else F.coalesce(ts >= F.lit(mark).cast(batch.schema[ts_col].dataType), F.lit(False))
        last(dedup_latest(batch.where(in_time), id_cols, newest_first(batch, id_cols, ts_col)), epoch)
        late(batch.where(~in_time), epoch)
        marks(batch.agg(F.max(ts_col).alias("newest")).where("newest IS NOT NULL"), epoch)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_last(spark: SparkSession, path: str, id_cols: list[str], ts_col: str) -> DataFrame:
    """The current row of each id: the latest time, then the latest batch."""
    df = spark.read.parquet(path)
    return dedup_latest(df, id_cols, newest_first(df, id_cols, ts_col)).drop("epoch")
