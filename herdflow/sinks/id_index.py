"""Which partitions of a landing hold an id: a small table beside it, so that a run reads only those.

The table lies in ``_ids`` (readers skip it): a hash of the id columns, the partition value, and a slot of the
hash as a partition column, a folder a run. It holds every landed id and may hold more: a run adds its ids before
it moves any rows, an id that has moved keeps its old entry, and two ids may share a hash. All that an entry too
many costs is one partition read. Runs are merged once there are more than `MOST_RUNS`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.session import delete_path, hadoop_fs, path_exists

INDEX_DIR = "_ids"
SLOTS = 256
MOST_RUNS = 16
_READY = "_READY"
_SCHEMA = "h long, part string, run string, slot int"


def entries(rows: DataFrame, ids: list[str], col: str) -> DataFrame:
    """(h, part, slot): the distinct entries of rows."""
    h = F.xxhash64(*[F.col(c).cast("string") for c in ids])
    return (rows.select(h.alias("h"), F.col(col).cast("string").alias("part")).distinct()
            .withColumn("slot", F.pmod("h", F.lit(SLOTS)).cast("int")))


def ready(spark: SparkSession, path: str) -> bool:
    """Whether the landing's index covers all its rows."""
    return path_exists(spark, f"{path}/{INDEX_DIR}/{_READY}")


def build(spark: SparkSession, path: str, landed: DataFrame | None, ids: list[str], col: str) -> None:
    """Index a landing that has no complete index yet (one scan of its ids)."""
    delete_path(spark, f"{path}/{INDEX_DIR}")
    jvm, fs = hadoop_fs(spark, path)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{path}/{INDEX_DIR}"))
    if landed is not None:
        add(spark, path, entries(landed, ids, col))
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{INDEX_DIR}/{_READY}"), True).close()


def runs(spark: SparkSession, path: str) -> list[str]:
    """Folders of the index."""
    jvm, fs = hadoop_fs(spark, path)
    found = fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{INDEX_DIR}"))
    return [s.getPath().toString() for s in found if s.isDirectory()]


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{path}/{INDEX_DIR}")


def _write(found: DataFrame, path: str) -> None:
    # sorted by hash, so that a look-up of few ids skips row groups by their bounds
    (found.select("h", "part", "slot").hint("rebalance", "slot").sortWithinPartitions("slot", "h")
     .write.partitionBy("slot").parquet(f"{path}/{INDEX_DIR}/run={uuid.uuid4().hex[:12]}"))


def add(spark: SparkSession, path: str, found: DataFrame) -> None:
    """Add a batch's entries that are not there yet; merge runs when there are many.

    The merged run is complete before the others go; a run that stops in between leaves entries twice.
    """
    before = runs(spark, path)
    if before:
        slots = _slots(found)
        old = read(spark, path).where(F.col("slot").isin(slots)).select("slot", "h", "part")
        same = (F.col("n.slot") == F.col("o.slot")) & (F.col("n.h") == F.col("o.h")) & F.col("n.part").eqNullSafe(F.col("o.part"))
        found = found.alias("n").join(old.alias("o"), same, "left_anti")
    _write(found, path)
    if len(before) >= MOST_RUNS:
        old = runs(spark, path)
        _write(read(spark, path).select("h", "part", "slot").distinct(), path)
        for folder in old:
            delete_path(spark, folder)


def _slots(found: DataFrame) -> list[int]:
    return sorted(r["slot"] for r in found.select("slot").distinct().collect())      # at most SLOTS


def lookup(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """(part, n_ids): the partitions that may hold ids of `found`, from the slots of those ids only."""
    own = found.select("slot", "h").distinct()
    there = read(spark, path).where(F.col("slot").isin(_slots(found))).select("slot", "h", "part").distinct()
    return there.join(own, ["slot", "h"], "left_semi").groupBy("part").agg(F.count(F.lit(1)).alias("n_ids"))
