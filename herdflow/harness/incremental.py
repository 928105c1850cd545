"""Registered queries of the incremental parts: indexed landing, bin join, day states, kept month
tables, repairs written back, counted runs and the streaming job. Registered like those of `catalog`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdflow.functions.text import normalize_id
from herdflow.harness import analogs as A
from herdflow.harness import sqlfn as q
from herdflow.harness.catalog import (_MONTH_GROUPS_CTES, _MONTH_SUMMARY_SELECT, _SQL_BLOB_META, _WEEKLY_SELECT, REGISTRY,
                                      _master_sql, _weekly_sql_ctes, register)
from herdflow.harness.sqlfn import with_ctes
from herdflow.operators import aggregates as AG
from herdflow.operators import coverage_state as CS
from herdflow.operators import quality as QC
from herdflow.operators import repair as R
from herdflow.operators.bands import Span, band_join
from herdflow.plans.runs import finish_rows
from herdflow.session import hadoop_fs, scratch_path, staged
from herdflow.sinks.landing import land_raw, landed_in
from herdflow.sinks.master import read_table, upsert_days, upsert_latest, write_back
from herdflow.sources.blobs import parse_blobs, scan_raw_csv
from herdflow.sources.snapshots import load_snapshot

__all__ = ["REGISTRY"]


# ------------------------------------------------------------------- landing with an id index
@register("landed_days_of_batch", with_ctes([_SQL_BLOB_META], """
SELECT CAST(substr(createdAt, 1, 10) AS DATE) AS file_date, CAST(count(*) AS BIGINT) AS n_ids
FROM bm WHERE device = 'CIMA1' AND trim(operationTag) <> '' GROUP BY 1"""))
def q_landed_days_of_batch(spark, d):
    """The landed days that hold a batch's ids, when its records come again under other days."""
    path = scratch_path(spark, "landing")
    mine = A.blobs(spark, d).where(F.col("device") == "CIMA1").drop("device")
    land_raw(mine, path, "CIMA1")
    again = mine.where(F.trim("operationTag") != "").withColumn("createdAt", F.lit("2024-03-01T00:00:00"))
    return landed_in(again, path, "CIMA1")


# ------------------------------------------------------------------------------ bin join
@register("band_join_many", """
SELECT p_partkey AS band, CAST(count(*) AS BIGINT) AS n, max(l_orderkey) AS last_order
FROM (SELECT *, l_extendedprice / l_quantity AS unit FROM lineitem) l
JOIN part ON unit >= p_retailprice - p_size * 0.02::DOUBLE AND unit < p_retailprice + p_size * 0.02::DOUBLE
GROUP BY p_partkey""")
def q_band_join_many(spark, d):
    """Line items within a price band around every part: as many overlapping bands as there are parts."""
    half = F.col("p_size") * F.lit(0.02)
    bands = A.table(spark, d, "part").select(F.col("p_partkey").alias("b_id"), (F.col("p_retailprice") - half).alias("b_low"),
                                             (F.col("p_retailprice") + half).alias("b_high"))
    items = A.table(spark, d, "lineitem").select("l_orderkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    met = band_join(items, bands, None, [Span("unit", "b_low", "b_high", high_in=False)],
                    {"n": ("count", None), "last_order": ("max", "l_orderkey")})
    return met.groupBy(F.col("b_id").alias("band")).agg(F.sum("n").alias("n"), F.max("last_order").alias("last_order"))


# ---------------------------------------------------------------- day states and month tables
def _late(df: DataFrame) -> DataFrame:
    """Rows that come a load later, some of them for every day."""
    return df.where(F.crc32(F.col("ear_tag").cast("binary")) % 4 == 1)


def _loads(spark, d):
    """Two loads of the master: most rows first, then late rows; after each its table and the days it touched."""
    path = scratch_path(spark, "master")
    rows = A.master(spark, d)
    for part in (rows.join(_late(rows).select("date", "ear_tag", "device"), ["date", "ear_tag", "device"], "left_anti"), _late(rows)):
        done = upsert_days(part, path)
        yield done.table, done.days


def _states(spark, d, report: str) -> DataFrame:
    path, numbers = scratch_path(spark, "states"), scratch_path(spark, "animals")
    for table, days in _loads(spark, d):
        CS.refresh_states(spark, table, path, CS.number_animals(spark, numbers, table), days, report)
    return CS.read_states(spark, path)


@register("coverage_of_day_states", _master_sql(_WEEKLY_SELECT, _weekly_sql_ctes(A.MONTH_START, A.REPORT_DAY)))
def q_coverage_of_day_states(spark, d):
    """The weekly report merged from day bitmaps, after a load of late rows."""
    return CS.weekly_coverage_of_states(_states(spark, d, CS.WEEKLY), A.herd_snapshots(spark, d), A.REPORT_DAY)


@register("groups_of_day_states", _master_sql(_MONTH_SUMMARY_SELECT, _MONTH_GROUPS_CTES))
def q_groups_of_day_states(spark, d):
    """The monthly group report merged from day bitmaps, after a load of late rows."""
    return CS.month_groups_of_states(_states(spark, d, CS.MONTHLY), A.herd_snapshots(spark, d), A.MONTH_START, A.MONTH_END)


@register("months_after_late_load", REGISTRY["monthly_by_key"][1])
def q_months_after_late_load(spark, d):
    """The kept month table after a load of late rows equals a full rebuild."""
    path = scratch_path(spark, "months")
    for table, days in _loads(spark, d):
        AG.refresh_months(table, path, days)
    return AG.read_months(spark, path)


# ------------------------------------------------------------------------- repairs written back
def _spoiled(spark, d) -> str:
    """A master whose groups read 'N/A' and whose ages are negative on every fifth day."""
    path = scratch_path(spark, "master")
    fifth = F.dayofmonth("date") % 5 == 0
    rows = A.master(spark, d).withColumn("group_name", F.when(fifth, F.lit(" N/A ")).otherwise(F.col("group_name")))
    upsert_latest(rows.withColumn("age_days", F.when(fifth, F.lit(-3).cast("smallint")).otherwise(F.col("age_days"))), path)
    return path


@register("repair_written_back", _master_sql("""
SELECT date, ear_tag, device, CASE WHEN day(date) % 5 <> 0 THEN group_name END AS group_name,
       CAST(CASE WHEN day(date) % 5 <> 0 AND age_days >= 0 THEN age_days END AS SMALLINT) AS age_days FROM master"""))
def q_repair_written_back(spark, d):
    """The master after its null repair was written back."""
    path = _spoiled(spark, d)
    write_back(spark, path, R.repair_nulls)
    return read_table(spark, path).select("date", "ear_tag", "device", "group_name", "age_days")


@register("repair_changed_days", _master_sql("""
SELECT strftime(date, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n_before, CAST(count(*) AS BIGINT) AS n_after FROM master
GROUP BY date HAVING day(date) % 5 = 0 OR count(*) FILTER (age_days < 0) > 0 OR count(*) FILTER (age_month < 0) > 0"""))
def q_repair_changed_days(spark, d):
    """The days that the repair rewrites; a second repair finds none."""
    path = _spoiled(spark, d)
    first = write_back(spark, path, R.repair_nulls)
    return first.unionAll(write_back(spark, path, R.repair_nulls)).select("day", "n_before", "n_after")


# ------------------------------------------------------------------------------ counted runs
@register("gate_after_merge", with_ctes([
    A.SQL_WEIGH_ROWS.replace("wr AS", "wr0 AS", 1), """wr AS (
  SELECT * REPLACE (CASE WHEN event_id % 10 <> 0 THEN 'Z' || ear_tag ELSE ear_tag END AS ear_tag,
                    CASE WHEN event_id % 10 <> 0 THEN 5000.0::DOUBLE ELSE weight END AS weight) FROM wr0)""",
    A.SQL_HERD, A.SQL_ENRICHED, A.SQL_MASTER], """
SELECT 'completed' AS status, CASE WHEN count(no) / count(*) >= 0.3 THEN 'ok' ELSE 'alert' END AS gate,
       (SELECT CASE WHEN count(no) / count(*) >= 0.3 THEN 'ok' ELSE 'alert' END FROM master) AS gate_after_filter,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(count(no) AS BIGINT) AS n_matched,
       CAST(count(*) FILTER (NOT coalesce(weight BETWEEN 60 AND 900, false)) AS BIGINT) AS n_outside,
       CAST(count(*) FILTER (weight BETWEEN 60 AND 900) AS BIGINT) AS n_new, (SELECT CAST(count(*) AS BIGINT) FROM master) AS n_master
FROM en"""))
def q_gate_after_merge(spark, d):
    """Counts and gate of a run in which nine rows of ten have no animal and a weight out of range: the gate looks at all rows."""
    rows = A.weigh_rows(spark, d)
    bad = F.col("event_id") % 10 != 0
    rows = rows.withColumns({"ear_tag": F.when(bad, F.concat(F.lit("Z"), "ear_tag")).otherwise(F.col("ear_tag")),
                             "weight": F.when(bad, F.lit(5000.0)).otherwise(F.col("weight"))})
    run = finish_rows(rows, load_snapshot(A.herd_snapshots(spark, d)), "db_latest", A.LOADED_AT, scratch_path(spark, "master"))
    after = QC.join_rate_gate(run.table).first()["status"]
    c = run.counts
    return spark.createDataFrame(
        [(run.status, run.join_rate, after, c["rows"], c["matched"], c["outside_range"], c["new"], c["master"])],
        "status string, gate string, gate_after_filter string, n_rows bigint, n_matched bigint, n_outside bigint, n_new bigint, n_master bigint")


def _change_sql(col: str, after: str) -> str:
    return f"""SELECT '{col}' AS "column", count(*) FILTER ({col} IS NULL) AS nulls_before, count(*) FILTER (a IS NULL) AS nulls_after,
       count(*) FILTER (lower({q.strip(col)}) = 'nan') AS nan_text_before, count(*) FILTER (lower({q.strip('a')}) = 'nan') AS nan_text_after,
       count(*) FILTER ({col} IS DISTINCT FROM a) AS n_changed, count(*) FILTER ({col} IS NOT NULL AND a IS NULL) AS n_newly_null,
       count(DISTINCT {col}) AS distinct_before, count(DISTINCT a) AS distinct_after,
       count(DISTINCT {col}) FILTER (a IS NOT NULL) - count(DISTINCT a) FILTER ({col} IS NOT NULL) AS n_newly_equal
FROM (SELECT *, {after} AS a FROM mixed)"""


@register("profile_change", with_ctes([A.SQL_HERD, """mixed AS (
  SELECT transp_2, no FROM herd UNION ALL SELECT ' nan ', '00' || no || '.0' FROM herd)"""],
    "\nUNION ALL\n".join(_change_sql(c, q.normalize_id(c)) for c in ("transp_2", "no"))))
def q_profile_change(spark, d):
    """What id normalisation does to the herd's two id columns, with each number written in a second way."""
    herd = A.herd_snapshots(spark, d).select("transp_2", "no")
    mixed = herd.unionAll(herd.select(F.lit(" nan "), F.concat(F.lit("00"), "no", F.lit(".0"))))
    return QC.profile_change(mixed, {c: normalize_id(c) for c in ("transp_2", "no")})


# ------------------------------------------------------------------------------ streaming job
@register("weigh_stream", with_ctes([A.SQL_WEIGH_ROWS, A.SQL_HERD, A.SQL_ENRICHED, A.SQL_MASTER], "SELECT * FROM master"))
def q_weigh_stream(spark, d):
    """Landed blobs through the streaming job: a landing a trigger, one landing sent again, then all replayed from new checkpoints."""
    from herdflow.streaming.jobs import weigh_stream
    from herdflow.streaming.streams import ingest_stream
    root = scratch_path(spark, "stream")
    bl, herd = staged(A.blobs(spark, d), "stream-blobs"), staged(A.herd_snapshots(spark, d), "stream-herd")

    def run(source: str, name: str) -> None:
        s = ingest_stream(spark, source, bl.schema).select(*bl.columns, "_file_time")
        weigh_stream(s, f"{root}/master", f"{root}/ck{name}", lambda: herd, f"{root}/log{name}").awaitTermination()
    landings = ("CIMA1", "CIMA2", "CIMA1")
    for i, dev in enumerate(landings):                    # as many files as there are tasks, all in one trigger
        bl.where(F.col("device") == dev).write.parquet(f"{root}/in/landing-{i}")
        run(f"{root}/in/*", "0")
    for i in range(len(landings)):
        run(f"{root}/in/landing-{i}", f"1-{i}")
    return read_table(spark, f"{root}/master").drop("loaded_at", "day")


# ------------------------------------------------------------------------- file-level scans
@register("read_raw_csv", with_ctes([f"""bl AS (
  SELECT *, min(ts) OVER (PARTITION BY event_type, event_id // {A.BLOB_SIZE}) AS first_ts FROM events)"""], f"""
SELECT CAST(first_ts AS DATE) AS file_date, NULLIF({A.SQL_OP_TAG}, '') AS operation_tag, CAST(event_id AS VARCHAR) AS stt, value AS weight
FROM bl WHERE CAST(first_ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""))
def q_read_raw_csv(spark, d):
    """Blobs landed as CSV files named by their day, with a file that has no date and one without the columns, read back by a window."""
    path = scratch_path(spark, "raw_csv")
    bl = A.blobs(spark, d).withColumn("day", F.substring("createdAt", 1, 10))
    bl.write.partitionBy("day").option("header", True).option("escape", '"').csv(f"{path}/days")
    bl.limit(0).select("id").coalesce(1).write.option("header", True).csv(f"{path}/bad")
    _named(spark, path)
    rows = scan_raw_csv(spark, f"{path}/files", "2024-01-10", "2024-01-20").rows
    return parse_blobs(rows, keep=("file_date",)).select("file_date", "operation_tag", "stt", "weight")


@register("raw_csv_files", f"""
SELECT status, CAST(count(*) AS BIGINT) AS n_files FROM (
  SELECT CASE WHEN d BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' THEN 'read' ELSE 'outside' END AS status
  FROM (SELECT DISTINCT CAST(min(ts) AS DATE) AS d FROM events GROUP BY event_type, event_id // {A.BLOB_SIZE})
  UNION ALL SELECT 'undated' UNION ALL SELECT 'unreadable') GROUP BY status""")
def q_raw_csv_files(spark, d):
    """What became of each file of that folder."""
    path = scratch_path(spark, "raw_csv")
    bl = A.blobs(spark, d).withColumn("day", F.substring("createdAt", 1, 10)).repartition("day")
    bl.write.partitionBy("day").option("header", True).option("escape", '"').csv(f"{path}/days")
    bl.limit(0).select("id").coalesce(1).write.option("header", True).csv(f"{path}/bad")
    _named(spark, path)
    return scan_raw_csv(spark, f"{path}/files", "2024-01-10", "2024-01-20").files.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def _named(spark, path: str) -> None:
    """Move written parts to files that carry their day in the name, as landed ones do."""
    jvm, fs = hadoop_fs(spark, path)
    at = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(at(f"{path}/files"))
    for folder in fs.listStatus(at(f"{path}/days")):
        day = folder.getPath().getName().partition("=")[2]
        for i, part in enumerate(p for p in fs.listStatus(folder.getPath()) if p.getPath().getName().endswith(".csv")) if day else ():
            fs.rename(part.getPath(), at(f"{path}/files/raw_A_{i}_direct_{day}.csv"))
    part = next(p for p in fs.listStatus(at(f"{path}/bad")) if p.getPath().getName().endswith(".csv"))
    fs.rename(part.getPath(), at(f"{path}/files/raw_A_direct_2024-01-11.csv"))
    out = fs.create(at(f"{path}/files/raw_A_undated.csv"), True)
    out.write(bytearray(b"id,operationTag,createdAt,file\n"))
    out.close()


# ------------------------------------------------------------------- last row of an id in a stream
@register("stream_last_per_id", """
SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1000 ELSE value END AS value, false AS late FROM events
UNION ALL SELECT event_id, value + 5000, true FROM events WHERE ts < TIMESTAMP '2024-01-06'""")
def q_stream_last_per_id(spark, d):
    """The last row of each id over three landings: the second corrects rows within the lateness, the third rows beyond it."""
    from herdflow.streaming.last import last_per_id, read_last
    from herdflow.streaming.streams import ingest_stream
    root = scratch_path(spark, "stream")
    e = A.table(spark, d, "events").select("event_id", "ts", "value")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    lands = [e, e.where(F.col("ts") >= at("2024-01-15")).withColumn("value", F.col("value") + 1000),
             e.where(F.col("ts") < at("2024-01-06")).withColumn("value", F.col("value") + 5000)]
    for i, rows in enumerate(lands):
        rows.write.parquet(f"{root}/in/part={i}")
        s = ingest_stream(spark, f"{root}/in", e.schema).select("event_id", "ts", "value")
        last_per_id(s, ["event_id"], "ts", f"{root}/last", f"{root}/late", f"{root}/ck", "16 days").awaitTermination()
    last = read_last(spark, f"{root}/last", ["event_id"], "ts").select("event_id", "value", F.lit(False).alias("late"))
    return last.unionAll(spark.read.parquet(f"{root}/late").select("event_id", "value", F.lit(True).alias("late")))
