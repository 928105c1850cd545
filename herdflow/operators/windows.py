"""Ordered operators that must not funnel the whole table through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdflow.session import shared_dir


def running_total(df: DataFrame, order: list[Column | str], value: str, out: str = "before",
                  partitions: int | None = None) -> DataFrame:
    """Exclusive running sum of `value` in a global `order` (which must be a total order).

    Distributed prefix sum instead of one unpartitioned window:
      1. range-partition on the order (sampling splits hot values of the leading column
         across partitions because the order is total) and checkpoint, so every row keeps
         its partition id on recomputation;
      2. per-partition totals -> at most `partitions` rows -> their exclusive prefix sum
         (a window over that tiny table);
      3. within-partition running sum, plus the partition's offset (broadcast; its size
         is bounded by the partition count).
    """
    spark = df.sparkSession
    shared_dir(spark)                       # the checkpoint goes to the shared folder
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    staged = (df.repartitionByRange(n, *cols)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    v = F.coalesce(F.col(value), F.lit(0))
    totals = staged.groupBy("_pid").agg(F.sum(v).alias("_t"))
    offsets = totals.select("_pid", F.coalesce(
        F.sum("_t").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    within = staged.withColumn("_in", F.coalesce(F.sum(v).over(
        Window.partitionBy("_pid").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (within.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_in"))
            .drop("_pid", "_off", "_in"))
