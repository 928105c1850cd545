"""Landed text blobs: scan with file-date pruning, explode to lines, parse weigh lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.functions.blob import is_valid_line, normalize_newlines, parse_weigh_line
from herdflow.functions.dates import file_date
from herdflow.schemas import PARSED_BLOB_SCHEMA
from herdflow.sources.files import FileScan, scan_csv

RAW_BLOB_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("operationTag", T.StringType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("file", T.StringType()),
])


def empty_parsed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PARSED_BLOB_SCHEMA)


def explode_lines(df: DataFrame, file_col: str = "file", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per blob line with its ordinal (`line_no`); null blob -> one empty line."""
    return df.select(*keep, F.posexplode(F.split(normalize_newlines(file_col), "\n"))
                     .alias("line_no", "line"))


def parse_blobs(df: DataFrame, tag_col: str = "operationTag", file_col: str = "file",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Blob table -> one row per weigh line (operation_tag, stt, weight, ear_tag, date, time).

    Header/footer/blank lines and lines with fewer than five fields are dropped; a bad
    weight or date becomes null and the row is kept. Missing input columns -> empty result.
    """
    if tag_col not in df.columns or file_col not in df.columns:
        return empty_parsed(df.sparkSession)
    lines = explode_lines(df, file_col, keep=(*keep, F.col(tag_col).alias("operation_tag")))
    parsed = (lines.where(is_valid_line("line"))
              .select(*keep, "operation_tag", parse_weigh_line("line").alias("p"))
              .where(F.col("p.n_fields") >= 5))
    return parsed.select(
        *keep, F.col("operation_tag").cast("string").alias("operation_tag"),
        "p.stt", "p.weight", "p.ear_tag", "p.date", "p.time")


def read_raw_blobs(spark: SparkSession, path: str, date_from=None, date_to=None,
                   devices: list[str] | None = None) -> DataFrame:
    """Landed blob table partitioned by ``device`` / ``file_date``.

    Date window and device list become partition filters, so only the matching
    directories are listed and read.
    """
    df = spark.read.parquet(path)
    if devices is not None:
        df = df.where(F.col("device").isin(list(devices)))
    if date_from is not None:
        df = df.where(F.col("file_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.where(F.col("file_date") <= F.lit(date_to).cast("date"))
    return df


def scan_raw_csv(spark: SparkSession, path: str, date_from=None, date_to=None, schema: T.StructType = RAW_BLOB_SCHEMA) -> FileScan:
    """Raw CSV files whose *name* carries the date. Files outside ``[from, to]`` or without a date are not opened; files
    without the columns of a blob are left out. The scan's `files` says what became of each."""
    found = scan_csv(spark, path, schema, ["operationTag", "file"], "*.csv", file_date("name"), date_from, date_to, keep_date=True,
                     multiLine=True, escape='"')
    return FileScan(found.rows, found.files)


def read_raw_csv(spark: SparkSession, path: str, date_from=None, date_to=None,
                 schema: T.StructType = RAW_BLOB_SCHEMA) -> DataFrame:
    """The rows of `scan_raw_csv` with their ``file_date``."""
    return scan_raw_csv(spark, path, date_from, date_to, schema).rows
