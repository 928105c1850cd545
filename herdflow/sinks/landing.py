"""Raw landing of fetched records and sessions (idempotent re-landing)."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.functions.text import safe_name
from herdflow.operators.dedup import dedup_latest
from herdflow.session import delete_path, hadoop_fs
from herdflow.sinks import id_index
from herdflow.sinks.master import STAGING_DIR, has_data, mark_committed, recover_staged, staged_partitions, swap_partitions, writing


def landing_buckets(df: DataFrame, op_col: str = "operationTag", created_col: str = "createdAt") -> DataFrame:
    """Route rows: a non-blank operation -> its own bucket (file-safe name); otherwise a
    ``direct_<createdAt date>`` bucket (``unknown`` without a date). Adds `kind`, `bucket`,
    and `file_date` (the partition value)."""
    op = F.col(op_col)
    has_op = op.isNotNull() & (F.trim(op) != "")
    day = F.coalesce(F.substring(F.col(created_col), 1, 10), F.lit("unknown"))
    return (df.withColumn("kind", F.when(has_op, F.lit("operation")).otherwise(F.lit("direct")))
            .withColumn("bucket", F.when(has_op, safe_name(op, strict=True))
                        .otherwise(F.concat(F.lit("direct_"), day)))
            .withColumn("file_date", F.try_to_date(F.substring(F.col(created_col), 1, 10), "yyyy-MM-dd")))


SCHEMA_FILE = "_schema.json"


def _save_schema(spark: SparkSession, path: str, schema: T.StructType, col: str) -> None:
    """Keep the table's columns (all but the partition column) beside it, so that no reader opens every file for them."""
    jvm, fs = hadoop_fs(spark, path)
    kept = T.StructType([f for f in schema.fields if f.name != col])
    out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_FILE}"), True)
    out.write(bytearray(kept.json().encode()))
    out.close()


def _saved_schema(spark: SparkSession, path: str) -> T.StructType | None:
    jvm, fs = hadoop_fs(spark, path)
    file = jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_FILE}")
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return T.StructType.fromJson(json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    except ValueError:                         # written half: the files know
        return None
    finally:
        stream.close()


def _pinned(spark: SparkSession, path: str, **kinds: T.DataType) -> DataFrame:
    """Landed table with its partition columns pinned to their types (inference would make
    one VOID when only the null partition exists). Its columns come from the saved schema;
    without one, from all files."""
    saved = _saved_schema(spark, path)
    if saved is not None:
        return spark.read.schema(T.StructType([*saved.fields, *[T.StructField(c, t) for c, t in kinds.items()]])).parquet(path)
    df = spark.read.option("mergeSchema", "true").parquet(path)
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in df.schema.fields])
    return df if schema == df.schema else spark.read.schema(schema).parquet(path)


def replace_by_id(new: DataFrame, path: str, col: str, kind: T.DataType, ids: list[str], write: bool = True) -> DataFrame:
    """Put `new` into a table partitioned by `col`, replacing every landed row that shares its
    `ids` (null-safe), whichever partition it is in. Landing the same rows again changes nothing.

    The batch is staged once. The index of landed ids (`id_index`) names the partitions that hold
    rows it replaces; those and the batch's own are merged into a marked stage and swapped in, and
    no file of another partition is opened. The batch's ids go into the index before any row moves.
    The next run finishes a swap that stopped. One run writes at a time. ``write=False`` returns the
    would-be partitions and changes nothing.
    """
    spark = new.sparkSession

    def merged(batch: DataFrame, touched: list) -> DataFrame:
        if not has_data(spark, path, col):
            return batch
        cond = F.col(col).isin([t for t in touched if t is not None])
        cond = cond | F.col(col).isNull() if None in touched else cond
        old = _pinned(spark, path, **{col: kind}).where(cond)
        return _without(old, batch, ids).unionByName(batch, allowMissingColumns=True)

    def touched_by(batch: DataFrame) -> list:
        days = batch.select(F.col(col).cast("string").alias("v"))
        if id_index.ready(spark, path):
            days = days.unionAll(id_index.lookup(spark, path, id_index.entries(batch, ids, col)).select(F.col("part").alias("v")))
        elif has_data(spark, path, col):       # a dry run before the first indexed one
            old = _pinned(spark, path, **{col: kind})
            days = days.unionAll(old.join(batch.select(*[F.col(c).alias("_n_" + c) for c in ids]),
                                          _same(ids), "left_semi").select(F.col(col).cast("string").alias("v")))
        return [r["v"] for r in days.distinct().collect()]       # one row per partition

    if not write:
        return merged(new, touched_by(new))
    jvm, fs = hadoop_fs(spark, path)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path))
    with writing(spark, path):
        delete_path(spark, f"{path}/_staging_in")
        recover_staged(spark, path, col)
        run = uuid.uuid4().hex[:12]
        batch_path, stage = f"{path}/_staging_in/{run}", f"{path}/{STAGING_DIR}/{run}"
        new.write.parquet(batch_path)
        batch = spark.read.schema(new.schema).parquet(batch_path)
        if not id_index.ready(spark, path):
            id_index.build(spark, path, _pinned(spark, path, **{col: kind}) if has_data(spark, path, col) else None, ids, col)
        touched = touched_by(batch)
        if touched:
            out = merged(batch, touched)
            id_index.add(spark, path, id_index.entries(batch, ids, col))
            out.hint("rebalance", col).sortWithinPartitions(col).write.partitionBy(col).parquet(stage)
            for v in touched:                  # a partition without rows left is replaced by an empty folder
                name = "__HIVE_DEFAULT_PARTITION__" if v is None else v
                fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{stage}/{col}={name}"))
            _save_schema(spark, path, out.schema, col)
            mark_committed(spark, stage)
            swap_partitions(spark, stage, path, col)
            delete_path(spark, stage)
        delete_path(spark, f"{path}/_staging_in")
    return _pinned(spark, path, **{col: kind}) if has_data(spark, path, col) else new.limit(0)


def _same(ids: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_n_" + c)) for c in ids])


def _without(old: DataFrame, batch: DataFrame, ids: list[str]) -> DataFrame:
    return old.join(batch.select(*[F.col(c).alias("_n_" + c) for c in ids]), _same(ids), "left_anti")


def land_raw(df: DataFrame, path: str, device: str, id_col: str = "id", write: bool = True) -> DataFrame:
    """Land one device's raw records under ``device=<device>/file_date=<day>``.

    One row per (bucket, id): a record that is sent again replaces the landed one, also when
    its day has changed; of equal ids in one batch the one created last stays. Ids are
    compared as text.
    """
    spark = df.sparkSession
    new = landing_buckets(df.withColumn(id_col, F.col(id_col).cast("string")))
    rest = sorted(c for c in df.columns if c != "createdAt" and df.schema[c].dataType.simpleString() in ("string", "bigint", "int"))
    new = dedup_latest(new, ["bucket", id_col], [F.col("createdAt").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest]])
    out = replace_by_id(new, f"{path}/device={device}", "file_date", T.DateType(), ["bucket", id_col], write)
    if write and has_data(spark, f"{path}/device={device}", "file_date"):
        return landed_raw(spark, path)
    return out.withColumn("device", F.lit(device))


def landed_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw records of all devices, with the columns that any of them has."""
    devices = staged_partitions(spark, path, "device")
    fields: dict[str, T.StructField] = {}
    for d in devices:
        saved = _saved_schema(spark, f"{path}/device={d}")
        if saved is None:
            return _pinned(spark, path, file_date=T.DateType())
        fields |= {f.name: f for f in saved.fields if f.name not in fields}
    parts = [T.StructField("device", T.StringType()), T.StructField("file_date", T.DateType())]
    return spark.read.schema(T.StructType([*fields.values(), *parts])).parquet(path)


def landed_in(df: DataFrame, path: str, device: str, id_col: str = "id") -> DataFrame:
    """(file_date, n_ids): the landed days of a device that hold ids of `df`, from the index alone. A day may be
    named too many (an id that has moved since), never too few."""
    new = landing_buckets(df.withColumn(id_col, F.col(id_col).cast("string")))
    found = id_index.lookup(df.sparkSession, f"{path}/device={device}", id_index.entries(new, ["bucket", id_col], "file_date"))
    return found.select(F.col("part").cast("date").alias("file_date"), "n_ids")


def landing_outcomes(df: DataFrame, path: str, device: str, id_col: str = "id") -> DataFrame:
    """What landing `df` would do, per bucket: n_rows received, n_new ids, n_landed ids that are
    there already, and the outcome (``written``: a new bucket, ``appended``: new ids for a
    landed bucket, ``skipped``: nothing new). Call it before `land_raw`."""
    spark = df.sparkSession
    new = landing_buckets(df.withColumn(id_col, F.col(id_col).cast("string")))
    got = new.groupBy("bucket", id_col).agg(F.count(F.lit(1)).alias("n"))
    sub = f"{path}/device={device}"
    if has_data(spark, sub, "file_date"):
        old = _pinned(spark, sub, file_date=T.DateType()).select("bucket", id_col).distinct()
    else:
        old = got.select("bucket", id_col).limit(0)
    ids = old.withColumnsRenamed({"bucket": "_n_bucket", id_col: "_n_" + id_col}).withColumn("_there", F.lit(True))
    known = old.select(F.col("bucket").alias("_b")).distinct().withColumn("_old", F.lit(True))
    j = got.join(ids, _same(["bucket", id_col]), "left").join(known, F.col("bucket") == F.col("_b"), "left")
    out = j.groupBy("bucket").agg(F.sum("n").alias("n_rows"), F.count_if(F.col("_there").isNull()).alias("n_new"),
                                  F.count_if(F.col("_there").isNotNull()).alias("n_landed"), F.max("_old").alias("_old"))
    outcome = (F.when(F.col("_old").isNull(), F.lit("written")).when(F.col("n_new") > 0, F.lit("appended")).otherwise(F.lit("skipped")))
    return out.select("bucket", "n_rows", "n_new", "n_landed", outcome.alias("outcome"))


def land_sessions(sessions: DataFrame, animals: DataFrame, path: str, write: bool = True) -> tuple[DataFrame, DataFrame]:
    """Land the session listing (including empty sessions, so they are not fetched again) and
    the sessions' animal rows; returns both tables. A session that is landed again replaces its
    own rows. Both are partitioned by session *month* (the day stays a column): a daily
    partition of a small listing would only produce many tiny folders. Animals go first, so a
    run that stops between the two fetches the sessions again. ``write=False`` changes nothing."""
    a = (animals.withColumn("session_date", F.col("date"))
         .withColumn("session_month", F.substring(F.col("date").cast("string"), 1, 7)))
    s = (sessions.withColumn("session_date", F.substring("createdAt", 1, 10))
         .withColumn("session_month", F.substring("createdAt", 1, 7)))
    kind = T.StringType()
    landed = replace_by_id(a, f"{path}/animals", "session_month", kind, ["session_id"], write)
    return replace_by_id(s, f"{path}/sessions", "session_month", kind, ["href"], write), landed
