"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.session import delete_path, scratch_path

#: White space of the word and line rules: space and the ASCII controls 9 to 13 (fixed values).
ASCII_SPACE = r"\x20\x09-\x0D"
WORD_SQL = rf"[^{ASCII_SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of the folder, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: What a task holds of long texts at once: bytes of a batch that goes to Python, rows of a batch read from Parquet.
TEXT_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def bound_batches(spark: SparkSession) -> None:
    """Set `TEXT_BATCHES`; a setting that the session was created with stays as it is."""
    given = spark.sparkContext.getConf()
    for k, v in TEXT_BATCHES.items():
        if not given.contains(k):
            spark.conf.set(k, v)


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the cluster's shared folder and read back.

    Cuts the lineage so that a lost executor costs a re-read, not a recomputation, and so
    that several consumers do not repeat the work above it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for scope in _scopes:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Ids of documents that are sent to every executor, 16 bytes each; more of them are joined instead.
FEW_IDS = 2_000_000


def few(ids: DataFrame) -> DataFrame:
    """Ids (a staged table) to join with, sent to every executor while they are few."""
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


_scopes: list[list[str]] = []


@contextlib.contextmanager
def work_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that are staged inside the block are deleted at its end, but for those staged by the function it gives."""
    mine: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        _scopes[:] = [s for s in _scopes if s is not mine]
        try:
            return staged(df, name)
        finally:
            _scopes.append(mine)

    _scopes.append(mine)
    try:
        yield keep
    finally:
        _scopes[:] = [s for s in _scopes if s is not mine]
        for path in mine:
            delete_path(spark, path)
