"""File-level scans of landed text files: what is outside a window is never opened, what cannot be read is
reported and left out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES_SCHEMA = "name string, path string, bytes bigint, file_date date, status string, missing array<string>"


@dataclass
class FileScan:
    """The rows of the files that were read, and a row for every file there is.

    `files` has the name, size, date and status of each: ``read``; ``outside`` the window and ``undated`` ones, which are
    not opened; ``empty``; ``unreadable`` (no line can be read, or the header lacks the `missing` columns).
    """

    rows: DataFrame
    files: DataFrame


def listed(spark: SparkSession, path: str, pattern: str, dated: Column | None = None) -> DataFrame:
    """(path, name, bytes, file_date) of the files below a folder, from their metadata alone. `dated` gives the date from `name`."""
    there = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    found = there.select("path", F.col("length").alias("bytes"))
    names = spark.createDataFrame([(p,) for p in there.inputFiles()], "path string")    # scans pass over files without a byte
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^([A-Za-z0-9]+):/*", "$1:/")
    none = names.join(found.select(plain(F.col("path")).alias("p")), plain(F.col("path")) == F.col("p"), "left_anti")
    found = found.unionAll(none.select("path", F.lit(0).cast("long")))
    found = found.withColumn("name", F.element_at(F.split("path", "/"), -1))
    return found.withColumn("file_date", dated if dated is not None else F.lit(None).cast("date"))


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, header): the first line of each file; a file that cannot be read has no row."""
    lines = (spark.read.option("ignoreCorruptFiles", True).text(paths)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
             .where("start = 0").withColumn("at", F.monotonically_increasing_id()))
    return lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, required: list[str], pattern: str = "*.csv",
             dated: Column | None = None, date_from=None, date_to=None, keep_date: bool = False, **options) -> FileScan:
    """CSV files with a header below a folder. With `dated`, files whose name has no date, or one outside the window, are
    not opened; `keep_date` adds it to the rows as ``file_date``. The driver holds a row a file, as the reader's own listing does."""
    files = listed(spark, path, pattern, dated)
    inside = F.lit(True)
    for bound, test in ((date_from, lambda b: F.col("file_date") >= b), (date_to, lambda b: F.col("file_date") <= b)):
        inside = inside & test(F.lit(bound).cast("date")) if bound is not None and dated is not None else inside
    status = F.when(F.col("bytes") == 0, "empty")
    if dated is not None:
        status = F.when(F.col("file_date").isNull(), "undated").when(~inside, "outside").when(F.col("bytes") == 0, "empty")
    files = files.withColumn("status", status).select("name", "path", "bytes", "file_date", "status").orderBy("path").collect()
    open_ = [f.path for f in files if f.status is None]
    names = F.transform(F.split(F.regexp_replace("header", "^\ufeff", ""), ","), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
    held = {}
    if open_:
        held = {_plain(r.path): r.names for r in headers(spark, open_).select("path", names.alias("names")).collect()}
    rows, good = [], {}
    for f in files:
        there = held.get(_plain(f.path), []) if f.status is None else []
        missing = [c for c in required if c not in there] if f.status is None else []
        state = f.status or ("unreadable" if missing or not there else "read")
        rows.append((f.name, f.path, f.bytes, f.file_date, state, missing))
        if state == "read":
            good.setdefault(tuple(there), []).append(f.path)
    # columns go by name: files of one header are read together
    df = None
    for there, paths in good.items():
        text = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(there))])
        part = spark.read.schema(text).option("header", True).option("basePath", path).options(**options).csv(paths)
        own = [(F.col(f"_{there.index(c.name)}") if c.name in there else F.lit(None)).cast(c.dataType).alias(c.name) for c in schema.fields]
        own += [F.col(c) for c in part.columns[len(there):]]             # columns of the folder layout
        part = part.withColumn("name", F.col("_metadata.file_name"))
        part = part.select(*own, *([dated.alias("file_date")] if keep_date else []))
        df = part if df is None else df.unionByName(part)
    if df is None:
        df = spark.createDataFrame([], T.StructType([*schema.fields, *([T.StructField("file_date", T.DateType())] if keep_date else [])]))
    return FileScan(df, spark.createDataFrame(rows, FILES_SCHEMA))


def _plain(path: str) -> str:
    """A path without its scheme's slashes, as listings write them in more than one way."""
    scheme, _, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}"
