"""Composed weigh jobs: blob job, session job, retention job and the daily run.

Each job is one lazy plan from scan to sink; the only actions are the writes and the
few one-row checks (emptiness, join rate) whose results go into the run log.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.functions.classify import add_animal_type
from herdflow.operators.conform import conform, drop_invalid_tags, filter_range
from herdflow.operators.enrich import enrich
from herdflow.operators.retention import select_for_retention
from herdflow.schemas import WEIGHT_HIGH, WEIGHT_LOW
from herdflow.sinks.landing import land_raw
from herdflow.sinks.master import upsert_latest
from herdflow.sources.blobs import parse_blobs, read_raw_blobs
from herdflow.sources.sessions import flatten_sessions


def transform_tail(rows: DataFrame, herd: DataFrame | None, loaded_at,
                   low: float = WEIGHT_LOW, high: float = WEIGHT_HIGH) -> DataFrame:
    """clean tag -> drop invalid tags -> herd enrichment -> class -> conform -> range filter.

    Invalid / empty tags are removed before the join, so no null-key group reaches the
    shuffle.
    """
    r = drop_invalid_tags(rows, "ear_tag")
    r = enrich(r, herd)
    r = add_animal_type(r)
    r = conform(r, loaded_at)
    return filter_range(r, "weight_kg", low, high)


def blob_rows(blobs: DataFrame, source: str = "PTM", device_col: str = "device") -> DataFrame:
    """Parsed weigh rows of landed blobs, tagged with source and device."""
    keep = (device_col,) if device_col in blobs.columns else ()
    p = parse_blobs(blobs, keep=keep)
    if device_col != "device" and keep:
        p = p.withColumnRenamed(device_col, "device")
    return p.withColumn("source", F.lit(source))


def blob_job(blobs: DataFrame, herd: DataFrame | None, loaded_at, master_path: str | None = None,
             source: str = "PTM", write: bool = True) -> DataFrame:
    """Blob weigh job: parse -> tail -> keep-latest upsert into the master."""
    rows = transform_tail(blob_rows(blobs, source), herd, loaded_at)
    if master_path is None:
        return rows
    return upsert_latest(rows, master_path, write=write)


def blob_run(spark: SparkSession, landing_path: str, device: str, herd: DataFrame | None, loaded_at,
             master_path: str | None, raw: DataFrame | None = None, mode: str = "full",
             date_from=None, date_to=None, write: bool = True) -> DataFrame:
    """One device's blob run in one of three modes.

    * ``land``: land the fetched records (`raw`) and stop (download only);
    * ``replay``: no fetch — read the landed blobs of ``[date_from, date_to]`` (partition
      pruned) and run the transform and upsert;
    * ``full``: land the fetched records, then transform them and upsert.
    Returns the landed table (land) or the master / would-be master (replay, full).
    """
    if mode not in ("land", "replay", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode in ("land", "full"):
        if raw is None:
            raise ValueError("land/full need the fetched records")
        landed = land_raw(raw, landing_path, device, write=write)
        if mode == "land":
            return landed
        blobs = raw.withColumn("device", F.lit(device))
    else:
        blobs = read_raw_blobs(spark, landing_path, date_from, date_to, [device])
    rows = transform_tail(blob_rows(blobs), herd, loaded_at)
    if master_path is None:
        return rows
    return upsert_latest(rows, master_path, write=write)


def session_rows(docs: DataFrame, device: str = "GALLAGHER_1", source: str = "GALLAGHER") -> DataFrame:
    flat = flatten_sessions(docs)
    return (flat.withColumn("date", F.try_to_date(F.col("date"), "yyyy-MM-dd"))
            .withColumn("source", F.lit(source)).withColumn("device", F.lit(device)))


def session_job(docs: DataFrame, herd: DataFrame | None, loaded_at, master_path: str | None = None,
                write: bool = True) -> DataFrame:
    """Session weigh job: flatten documents -> same tail -> upsert."""
    rows = transform_tail(session_rows(docs), herd, loaded_at)
    if master_path is None:
        return rows
    return upsert_latest(rows, master_path, write=write)


def retention_job(listing: DataFrame, landed: DataFrame, **kw) -> DataFrame:
    """Table of sessions to remove upstream (the removal call itself is outside Spark)."""
    return select_for_retention(listing, landed, **kw)


def daily_run(spark: SparkSession, steps: list[tuple[str, Callable[[], object]]]) -> DataFrame:
    """Run steps in order; a failing step does not stop the others. Returns one status
    row per step (name, status, seconds, message)."""
    out = []
    for name, fn in steps:
        t0 = time.time()
        try:
            fn()
            out.append((name, "completed", round(time.time() - t0, 2), ""))
        except Exception as e:  # noqa: BLE001 - one job failing must not stop the run
            out.append((name, "failed", round(time.time() - t0, 2), str(e) or type(e).__name__))
    return spark.createDataFrame(out, "job string, status string, seconds double, msg string")
