"""Nested session documents, record envelopes and incremental session selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.functions.text import session_id
from herdflow.session import hadoop_fs
from herdflow.sources.files import FileScan, scan_csv

SESSION_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                   ["session_id", "session_name", "date", "time", "ear_tag", "weight",
                                    "scan_date"]])


def flatten_sessions(df: DataFrame, id_col: str = "session_id") -> DataFrame:
    """Session document -> one row per animal.

    date = first 10 chars of createdAt; time = chars 12-16 when createdAt has at least
    16 chars, else ''; missing rfid / scanDate -> ''; missing weight -> null. Sessions
    with no animals contribute no rows.
    """
    created = F.coalesce(F.col("createdAt"), F.lit(""))
    a = (df.select(F.col(id_col).alias("session_id"),
                   F.coalesce(F.col("name"), F.lit("")).alias("session_name"),
                   created.alias("created"),
                   F.explode(F.col("animals.values")).alias("a")))
    return a.select(
        "session_id", "session_name",
        F.substring("created", 1, 10).alias("date"),
        F.when(F.length("created") >= 16, F.substring("created", 12, 5)).otherwise(F.lit("")).alias("time"),
        F.coalesce(F.col("a.rfid"), F.lit("")).alias("ear_tag"),
        F.col("a.currentWeight").cast("double").alias("weight"),
        F.coalesce(F.col("a.scanDate"), F.lit("")).alias("scan_date"),
    )


def parse_envelope(text: Column, record: T.StructType) -> Column:
    """A JSON page: either ``{"hydra:member": [...]}`` or a bare array -> array of records."""
    arr = T.ArrayType(record)
    env = T.StructType([T.StructField("hydra:member", arr)])
    t = F.ltrim(text)
    return (F.when(t.startswith("["), F.from_json(text, arr))
            .otherwise(F.from_json(text, env).getField("hydra:member")))


def flatten_envelope(df: DataFrame, text_col: str, record: T.StructType,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of each page; an empty page yields nothing."""
    return (df.select(*keep, F.explode(parse_envelope(F.col(text_col), record)).alias("r"))
            .select(*keep, "r.*"))


def new_sessions(listing: DataFrame, landed: DataFrame, href_col: str = "href",
                 landed_id_col: str = "session_id") -> DataFrame:
    """Listing entries whose numeric id (last href segment) is not landed yet.

    Entries with an unparsable id are dropped. Anti join: no pairs, the landed side is
    reduced to its distinct ids first.
    """
    lst = listing.withColumn("session_id", session_id(href_col)).where(F.col("session_id").isNotNull())
    ids = landed.select(F.col(landed_id_col).cast("bigint").alias("session_id")).distinct()
    return lst.join(ids, "session_id", "left_anti")


def deletable(listing: DataFrame, landed: DataFrame, href_col: str = "href",
              landed_id_col: str = "session_id") -> DataFrame:
    """Listing entries that are already landed (safe to remove upstream)."""
    lst = listing.withColumn("session_id", session_id(href_col)).where(F.col("session_id").isNotNull())
    ids = landed.select(F.col(landed_id_col).cast("bigint").alias("session_id")).distinct()
    return lst.join(ids, "session_id", "left_semi")


def scan_sessions(spark, path: str, date_from=None, date_to=None, schema: T.StructType = SESSION_CSV_SCHEMA) -> FileScan:
    """Landed session CSVs (all text) with ``date_from <= date <= date_to`` compared as ``YYYY-MM-DD`` text. Empty fields
    read as null. Files whose name starts with ``_`` or ``.`` are skipped by the reader, files whose header lacks the
    session's columns are left out and reported. In a layout of ``date=...`` folders, those outside the window are not opened."""
    foldered = any(n.startswith("date=") for n in _folders(spark, path))
    day = F.to_date(F.regexp_extract("path", r"/date=(\d{4}-\d{2}-\d{2})/", 1)) if foldered else None
    required = [c for c in ("session_id", "date", "ear_tag", "weight") if not (foldered and c == "date")]
    own = T.StructType([f for f in schema.fields if not (foldered and f.name == "date")])
    found = scan_csv(spark, path, own, required, "*.csv", day, date_from, date_to)
    df = found.rows
    if foldered:
        df = df.withColumn("date", F.col("date").cast("string") if "date" in df.columns else F.lit(None).cast("string"))
    df = df.select(*schema.names)
    if date_from is not None:
        df = df.where(F.col("date") >= F.lit(str(date_from)))
    if date_to is not None:
        df = df.where(F.col("date") <= F.lit(str(date_to)))
    return FileScan(df, found.files)


def read_sessions(spark, path: str, date_from=None, date_to=None, schema: T.StructType = SESSION_CSV_SCHEMA) -> DataFrame:
    """The rows of `scan_sessions`."""
    return scan_sessions(spark, path, date_from, date_to, schema).rows


def _folders(spark, path: str) -> list[str]:
    jvm, fs = hadoop_fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)) if s.isDirectory()]
