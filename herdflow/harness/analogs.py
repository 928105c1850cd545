"""Weigh-shaped inputs derived by Spark from the driver's tables, with the same
derivations as DuckDB CTEs for the oracle.

Analogy: an event is a weighing (event_type -> device, user_id -> ear tag, value ->
weight, ts -> date/time); a customer is a herd animal (c_custkey -> tag, c_mktsegment ->
group, c_acctbal -> age); three dated copies of the customers are the herd snapshots;
orders are weigh sessions, their line items the animals in them.

Every derivation keeps every row of its source table; variety (tag formats, blank
operations, null devices) comes from column values, never from dropping rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.harness import sqlfn as q
from herdflow.operators.dedup import dedup_latest, latest_order
from herdflow.plans.jobs import transform_tail
from herdflow.schemas import DEDUP_KEYS
from herdflow.sources.scan import read_parquet
from herdflow.sources.snapshots import load_snapshot

REPORT_DAY = dt.date(2024, 1, 26)          # weekly report day: week 4, threshold 30 %
MONTH_START, MONTH_END = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
FRESHNESS_DAY = dt.date(2024, 2, 5)
SNAP_BASE = dt.date(2024, 1, 31)
SNAP_OFFSETS = (-31, 0, 29)                # snapshots 2023-12-31, 2024-01-31, 2024-02-29
LOADED_AT = "2024-02-01 00:00:00"
BLOB_SIZE = 64                             # events per landed blob (bounded group)
SESSION_SIZE = 50                          # events per weigh session document
PAGE_SIZE = 100                            # records per API page


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{d}/{name}.parquet")


# ----------------------------------------------------------------------- weigh rows
def tag_text(uid: Column, et: Column) -> Column:
    u = uid.cast("string")
    return (F.when(et == "click", F.concat(F.lit("000"), u))
            .when(et == "view", F.concat(u, F.lit(".0"))).otherwise(u))


def device_of(et: Column) -> Column:
    return F.when(et.isin("click", "view"), F.lit("CIMA1")).otherwise(F.lit("CIMA2"))


SQL_TAG = ("CASE WHEN event_type = 'click' THEN '000' || CAST(user_id AS VARCHAR) "
           "WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) || '.0' "
           "ELSE CAST(user_id AS VARCHAR) END")
SQL_DEVICE = "CASE WHEN event_type IN ('click', 'view') THEN 'CIMA1' ELSE 'CIMA2' END"


def weigh_rows(spark: SparkSession, d: str) -> DataFrame:
    """One weigh row per event; 'error' events carry no tag (as a line without ``TR:``)."""
    e = table(spark, d, "events")
    et = F.col("event_type")
    return e.select(
        "event_id", F.lit("PTM").alias("source"), device_of(et).alias("device"),
        F.to_date("ts").alias("date"), F.date_format("ts", "HH:mm").alias("time"),
        F.when(et == "error", F.lit("")).otherwise(tag_text(F.col("user_id"), et)).alias("ear_tag"),
        F.col("value").alias("weight"))


SQL_WEIGH_ROWS = f"""wr AS (
  SELECT event_id, 'PTM' AS source, {SQL_DEVICE} AS device, CAST(ts AS DATE) AS date,
         strftime(ts, '%H:%M') AS time,
         CASE WHEN event_type = 'error' THEN '' ELSE {SQL_TAG} END AS ear_tag, value AS weight
  FROM events)"""


# --------------------------------------------------------------------------- blobs
def blobs(spark: SparkSession, d: str) -> DataFrame:
    """Landed text blobs: one per (event type, block of 64 event ids), with a header,
    footers, a short line and a blank line; CIMA2 blobs use CRLF line ends; 'signup'
    blobs have a blank operation (routed to the per-day bucket when landed)."""
    e = table(spark, d, "events")
    et = F.col("event_type")
    tag = tag_text(F.col("user_id"), et)
    line = F.concat_ws(
        ";", F.col("event_id").cast("string"),
        F.concat(F.lit(" "), F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))),
        F.when(et == "error", tag).otherwise(F.concat(F.lit("TR:"), tag)),
        F.date_format("ts", "dd/MM/yyyy"), F.date_format("ts", "HH:mm"), F.lit("S"))
    g = (e.select("event_id", "ts", "event_type", F.floor(F.col("event_id") / BLOB_SIZE).alias("blob_no"),
                  line.alias("line"))
         .groupBy("event_type", "blob_no")
         .agg(F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("n"),
              F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("ls")))
    dev = device_of(F.col("event_type"))

    def _file(nl: str) -> Column:
        body = F.array_join(F.transform("ls", lambda s: s["line"]), nl)
        return F.concat_ws(nl, F.lit("No;Weight;Tag;Date;Time;S"), body,
                           F.concat(F.lit("TOTAL SUM; "), F.col("n").cast("string")),
                           F.lit("average weight; 0"), F.lit("--"), F.lit(""))
    file = F.when(dev == "CIMA2", _file("\r\n")).otherwise(_file("\n"))
    return g.select(
        F.concat(F.col("event_type"), F.lit("-"), F.col("blob_no").cast("string")).alias("id"),
        dev.alias("device"),
        F.when(F.col("event_type") == "signup", F.lit(""))
        .otherwise(F.concat(F.col("event_type"), F.lit("-"), F.col("blob_no").cast("string"))).alias("operationTag"),
        F.date_format("first_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("createdAt"),
        file.alias("file"))


SQL_OP_TAG = ("CASE WHEN event_type = 'signup' THEN '' "
              f"ELSE event_type || '-' || CAST(event_id // {BLOB_SIZE} AS VARCHAR) END")


# ----------------------------------------------------------------------------- herd
def herd_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Three dated snapshots of the customers as herd rows (transp_2 in mixed formats,
    a null herd number for negative balances, ages shifted by the snapshot offset)."""
    c = table(spark, d, "customer")
    base_age = F.floor(F.abs(F.col("c_acctbal"))).cast("int") % 1100
    lac = F.when(base_age >= 700, F.col("c_nationkey") % 6).otherwise(F.lit(0))
    key = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    transp = (F.when(seg == "AUTOMOBILE", F.concat(F.lit("000"), key))
              .when(seg == "BUILDING", F.concat(key, F.lit(".0")))
              .when(seg == "FURNITURE", F.format_string("%.6e", F.col("c_custkey").cast("double")))
              .when(seg == "MACHINERY", F.concat(F.lit(" "), key, F.lit("\t")))
              .otherwise(key))
    h = c.select(
        transp.alias("transp_2"),
        F.when(F.col("c_acctbal") >= 0, (F.col("c_custkey") + 100000).cast("string")).alias("no"),
        seg.alias("group_name"), base_age.alias("base_age"), lac.alias("lac_no"),
        F.when(lac >= 1, (F.col("c_custkey") * 13) % 305).alias("base_dim"),
        F.explode(F.array(*[F.lit(k) for k in SNAP_OFFSETS])).alias("k"))
    return h.select(
        F.date_add(F.lit(SNAP_BASE), F.col("k")).alias("date"), "no", "transp_2", "group_name",
        (F.col("base_age") + F.col("k")).alias("age_days"),
        (F.col("base_dim") + F.col("k")).alias("dim"),
        F.col("lac_no").cast("int").alias("lac_no"),
        F.round((F.col("base_age") + F.col("k")) / F.lit(30.44), 1).alias("age_month_fix"))


_SNAP_OFFS = ", ".join(str(k) for k in SNAP_OFFSETS)
SQL_HERD = f"""hb AS (
  SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '000' || CAST(c_custkey AS VARCHAR)
                           WHEN 'BUILDING' THEN CAST(c_custkey AS VARCHAR) || '.0'
                           WHEN 'FURNITURE' THEN printf('%.6e', CAST(c_custkey AS DOUBLE))
                           WHEN 'MACHINERY' THEN ' ' || CAST(c_custkey AS VARCHAR) || chr(9)
                           ELSE CAST(c_custkey AS VARCHAR) END AS transp_2,
         CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey + 100000 AS VARCHAR) END AS no,
         c_mktsegment AS group_name,
         CAST(floor(abs(c_acctbal)) AS INTEGER) % 1100 AS base_age,
         c_nationkey, c_custkey, unnest([{_SNAP_OFFS}]) AS k
  FROM customer),
herd AS (
  SELECT DATE '{SNAP_BASE.isoformat()}' + k AS date, no, transp_2, group_name,
         base_age + k AS age_days,
         CASE WHEN base_age >= 700 AND c_nationkey % 6 >= 1 THEN (c_custkey * 13) % 305 + k END AS dim,
         CAST(CASE WHEN base_age >= 700 THEN c_nationkey % 6 ELSE 0 END AS INTEGER) AS lac_no,
         round((base_age + k) / CAST(30.44 AS DOUBLE), 1) AS age_month_fix
  FROM hb)"""


# --------------------------------------------------------------------------- master
def enriched_rows(spark: SparkSession, d: str) -> DataFrame:
    """Weigh rows with clean tags, enriched with the latest herd snapshot (no conform)."""
    from herdflow.operators.conform import drop_invalid_tags
    from herdflow.operators.enrich import enrich
    return enrich(drop_invalid_tags(weigh_rows(spark, d), "ear_tag"),
                  load_snapshot(herd_snapshots(spark, d)))


def master(spark: SparkSession, d: str) -> DataFrame:
    """Weigh master: tail of the weigh job on the latest snapshot, then keep-latest."""
    rows = transform_tail(weigh_rows(spark, d), load_snapshot(herd_snapshots(spark, d)), LOADED_AT)
    return dedup_latest(rows, DEDUP_KEYS, latest_order())


SQL_ENRICHED = f"""wv AS (
  SELECT * REPLACE ({q.clean_tag('ear_tag')} AS ear_tag) FROM wr
  WHERE {q.valid_tag(q.clean_tag('ear_tag'))}),
hl AS (
  SELECT {q.normalize_id('transp_2')} AS hkey, {q.normalize_id('no')} AS no, group_name,
         age_days, dim, lac_no, date AS snap
  FROM herd WHERE date = (SELECT max(date) FROM herd)),
en AS (
  SELECT wv.*, hl.no, hl.group_name, hl.lac_no,
         CASE WHEN hl.no IS NOT NULL THEN hl.age_days - date_diff('day', wv.date, hl.snap)
              ELSE hl.age_days END AS age_days0,
         CASE WHEN hl.no IS NOT NULL THEN hl.dim - date_diff('day', wv.date, hl.snap)
              ELSE hl.dim END AS dim0
  FROM wv LEFT JOIN hl ON {q.normalize_id('wv.ear_tag')} = hl.hkey)"""

SQL_MASTER = f"""cf AS (
  SELECT source, device, date, time, {q.null_conform('no')} AS no, ear_tag,
         {q.null_conform('group_name')} AS group_name,
         {q.classify('no', 'lac_no')} AS animal_type,
         weight AS weight_kg,
         CASE WHEN round(age_days0 / CAST(30.44 AS DOUBLE), 1) >= 0
              THEN round(age_days0 / CAST(30.44 AS DOUBLE), 1) + 0.0 END AS age_month,
         CAST(CASE WHEN age_days0 >= 0 THEN age_days0 END AS SMALLINT) AS age_days,
         CAST(CASE WHEN dim0 >= 0 THEN dim0 END AS SMALLINT) AS dim,
         CAST(lac_no AS TINYINT) AS lac_no
  FROM en WHERE weight BETWEEN 60 AND 900),
master AS (
  SELECT * FROM cf
  QUALIFY row_number() OVER (PARTITION BY date, ear_tag, device
                             ORDER BY time DESC, weight_kg DESC) = 1)"""

MASTER_CTES = [SQL_WEIGH_ROWS, SQL_HERD, SQL_ENRICHED, SQL_MASTER]


# ------------------------------------------------------------------ sessions/listing
def session_docs(spark: SparkSession, d: str) -> DataFrame:
    """Weigh-session documents as landed JSON text, parsed back with the document schema.

    A session = (event type, block of 50 event ids); 'signup' animals have no rfid;
    'error' sessions carry a date-only createdAt (shorter than 16 chars)."""
    from herdflow.schemas import SESSION_DOC_SCHEMA
    e = table(spark, d, "events")
    et = F.col("event_type")
    animal = F.struct(
        F.when(et != "signup", F.col("user_id").cast("string")).alias("rfid"),
        F.col("value").alias("currentWeight"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("scanDate"))
    g = (e.withColumn("chunk", F.floor(F.col("event_id") / SESSION_SIZE))
         .groupBy("event_type", "chunk")
         .agg(F.min("ts").alias("first_ts"), F.collect_list(animal).alias("vals")))
    created = F.when(F.col("event_type") == "error", F.date_format("first_ts", "yyyy-MM-dd")) \
        .otherwise(F.date_format("first_ts", "yyyy-MM-dd'T'HH:mm:ss"))
    text = F.to_json(F.struct(
        F.concat(F.col("event_type"), F.lit(" session "), F.col("chunk").cast("string")).alias("name"),
        created.alias("createdAt"),
        F.struct(F.col("vals").alias("values")).alias("animals")))
    sid = F.col("chunk") * 10 + F.when(et == "click", 1).when(et == "view", 2) \
        .when(et == "purchase", 3).when(et == "signup", 4).otherwise(5)
    landed = g.select(sid.alias("session_id"), text.alias("doc"))
    return landed.select("session_id", F.from_json("doc", SESSION_DOC_SCHEMA).alias("d")).select("session_id", "d.*")


SQL_SESSION_ID = (f"(event_id // {SESSION_SIZE}) * 10 + CASE event_type WHEN 'click' THEN 1 "
                  "WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END")


def session_listing(spark: SparkSession, d: str) -> DataFrame:
    """Orders as an upstream session listing: href ends in the order key (pending orders
    get a non-numeric suffix), animalCount = number of line items."""
    o = table(spark, d, "orders")
    n = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("animalCount"))
    href = F.concat(F.lit("/api/sessions/"), F.col("o_orderkey").cast("string"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("/detail")).otherwise(F.lit("")))
    return (o.join(n, o["o_orderkey"] == n["l_orderkey"], "left")
            .select(href.alias("href"), F.col("o_orderpriority").alias("name"),
                    F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("createdAt"),
                    F.coalesce(F.col("animalCount"), F.lit(0)).cast("bigint").alias("animalCount")))


def landed_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Landed session ids: orders having at least one finished line."""
    li = table(spark, d, "lineitem")
    return li.where(F.col("l_linestatus") == "F").select(F.col("l_orderkey").alias("session_id"))


SQL_LISTING = """cnt AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
listing AS (
  SELECT '/api/sessions/' || CAST(o_orderkey AS VARCHAR)
           || CASE WHEN o_orderstatus = 'P' THEN '/detail' ELSE '' END AS href,
         o_orderpriority AS name, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS createdAt,
         CAST(coalesce(cnt.n, 0) AS BIGINT) AS animalCount
  FROM orders LEFT JOIN cnt ON orders.o_orderkey = cnt.l_orderkey),
lst AS (
  SELECT *, TRY_CAST(CASE WHEN regexp_full_match(split_part(href, '/', -1), '\\d+')
                          THEN split_part(href, '/', -1) END AS BIGINT) AS session_id
  FROM listing),
landed AS (SELECT DISTINCT l_orderkey AS session_id FROM lineitem WHERE l_linestatus = 'F')"""


# ---------------------------------------------------------------------- legacy master
def legacy_master(spark: SparkSession, d: str) -> DataFrame:
    """An older master straight from events: null devices for low readings, mixed
    sources, placeholder strings, legacy classes and negative ages."""
    e = table(spark, d, "events")
    et, v = F.col("event_type"), F.col("value")
    uid = F.col("user_id").cast("string")
    return e.select(
        "event_id",
        F.when(et == "signup", F.lit("GALLAGHER")).when(et == "error", F.lit("OTHER"))
        .otherwise(F.lit("PTM")).alias("source"),
        F.when(v < 20, F.lit(None).cast("string")).otherwise(F.upper(et)).alias("device"),
        F.to_date("ts").alias("date"), F.date_format("ts", "HH:mm").alias("time"),
        F.when(v < 10, F.lit("nan")).when(v < 15, F.lit("<NA>")).when(v < 20, F.lit(" None "))
        .otherwise(uid).alias("no"),
        uid.alias("ear_tag"),
        F.when(v > 480, F.lit("N/A")).otherwise(et).alias("group_name"),
        F.when(et == "purchase", F.lit("milking_cow")).when(et == "view", F.lit("dry"))
        .otherwise(F.lit("heifer")).alias("animal_type"),
        v.alias("weight_kg"),
        (v / 10 - 2).alias("age_month"),
        (F.floor(v).cast("int") - 30).alias("age_days"),
        F.floor(v / 100).cast("int").alias("lac_no"),
        F.col("ts").alias("loaded_at"))


SQL_LEGACY = """lm AS (
  SELECT event_id,
         CASE event_type WHEN 'signup' THEN 'GALLAGHER' WHEN 'error' THEN 'OTHER' ELSE 'PTM' END AS source,
         CASE WHEN value < 20 THEN NULL ELSE upper(event_type) END AS device,
         CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS time,
         CASE WHEN value < 10 THEN 'nan' WHEN value < 15 THEN '<NA>' WHEN value < 20 THEN ' None '
              ELSE CAST(user_id AS VARCHAR) END AS no,
         CAST(user_id AS VARCHAR) AS ear_tag,
         CASE WHEN value > 480 THEN 'N/A' ELSE event_type END AS group_name,
         CASE event_type WHEN 'purchase' THEN 'milking_cow' WHEN 'view' THEN 'dry' ELSE 'heifer' END AS animal_type,
         value AS weight_kg, value / 10 - 2 AS age_month,
         CAST(floor(value) AS INTEGER) - 30 AS age_days,
         CAST(floor(value / 100) AS INTEGER) AS lac_no,
         ts AS loaded_at
  FROM events)"""
