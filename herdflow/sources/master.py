"""Master table reads, load windows and per-device tagging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.schemas import REFETCH_DAYS_BACK, REFETCH_DAYS_FORWARD


def read_master(spark: SparkSession, path: str, start=None, end=None,
                weighed_only: bool = False) -> DataFrame:
    """Master scan. ``start``/``end`` bound ``date`` (inclusive) and, through the derived
    ``day`` partition column, prune whole day directories."""
    from herdflow.sinks.master import read_table      # partition column pinned to text
    df = read_table(spark, path)
    if start is not None:
        s = F.lit(start).cast("date")
        df = df.where((F.col("date") >= s) & (F.col("day") >= F.date_format(s, "yyyy-MM-dd")))
    if end is not None:
        e = F.lit(end).cast("date")
        df = df.where((F.col("date") <= e) & (F.col("day") <= F.date_format(e, "yyyy-MM-dd")))
    if weighed_only:
        df = df.where(F.col("weight_kg").isNotNull())
    return df


def load_window(today: dt.date, date_from=None, date_to=None, mode: str = "fetch"):
    """(from, to) of a run.

    fetch: the override applies only when both ends are given, else [today-7, today+1];
    replay: each end defaults on its own, to today-7 and today.
    """
    def _d(x):
        return x if isinstance(x, dt.date) or x is None else dt.date.fromisoformat(str(x))
    date_from, date_to = _d(date_from), _d(date_to)
    back = today - dt.timedelta(days=REFETCH_DAYS_BACK)
    if mode == "fetch":
        if date_from is not None and date_to is not None:
            return date_from, date_to
        return back, today + dt.timedelta(days=REFETCH_DAYS_FORWARD)
    if mode == "replay":
        return (date_from or back), (date_to or today)
    raise ValueError(f"unknown mode {mode!r}")


def tag_and_union(frames: dict[str, DataFrame], source: str,
                  enabled: list[str] | None = None) -> DataFrame | None:
    """Tag each device's frame with literal source/device, drop disabled devices, union by name."""
    out = None
    for device, df in frames.items():
        if df is None or (enabled is not None and device not in enabled):
            continue
        t = df.withColumn("source", F.lit(source)).withColumn("device", F.lit(device))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out
