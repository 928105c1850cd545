"""Whole runs: a device's blob run, the session run, the daily run and the month bundle, with
their checks, counts and log rows."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from herdflow.functions.classify import add_animal_type
from herdflow.functions.numbers import small_reject
from herdflow.operators.aggregates import freshness
from herdflow.operators.conform import conform, drop_invalid_tags
from herdflow.operators.enrich import enrich
from herdflow.operators.quality import expect_non_empty, join_rate_status
from herdflow.plans.jobs import blob_rows, session_rows
from herdflow.plans.reports import daily_report, month_report, weekly_report
from herdflow.schemas import WEIGHT_HIGH, WEIGHT_LOW
from herdflow.session import staged
from herdflow.sinks.landing import land_raw, land_sessions
from herdflow.sinks.master import append_run_log, export_csv, upsert_days, write_month_bundle
from herdflow.sources.blobs import read_raw_blobs
from herdflow.sources.master import load_window, tag_and_union
from herdflow.sources.sessions import new_sessions
from herdflow.sources.snapshots import resolve_herd


@dataclass
class Run:
    """What a run did: ``completed``, ``failed``, ``no_new_data``, ``landed`` or ``skipped``; the resulting table;
    row counts (after the merge, matched, outside the range, new, in the master); the join-rate status; the
    herd's source; the days that it touched."""

    status: str
    table: DataFrame | None = None
    counts: dict[str, int] = field(default_factory=dict)
    join_rate: str = "skipped"
    herd: str = "none"
    days: list[str | None] = field(default_factory=list)

    @property
    def message(self) -> str:
        parts = [f"{k}={v}" for k, v in self.counts.items()]
        return " ".join([*parts, f"join_rate={self.join_rate}", f"herd={self.herd}"])


def counted_tail(rows: DataFrame, herd: DataFrame | None, loaded_at, low: float = WEIGHT_LOW,
                 high: float = WEIGHT_HIGH) -> tuple[DataFrame, Observation]:
    """`transform_tail` that counts as it goes: rows in, rows matched to the herd, numbers that do
    not fit their column, rows outside the weight range. The counts come with the first action."""
    obs = Observation("tail")
    r = add_animal_type(enrich(drop_invalid_tags(rows, "ear_tag"), herd))
    unfit = [F.count_if(small_reject(c, t)).alias(f"{c}_rejected")
             for c, t in (("age_days", "smallint"), ("dim", "smallint"), ("lac_no", "tinyint")) if c in r.columns]
    weight = "weight_kg" if "weight_kg" in r.columns else "weight"
    inside = F.coalesce(F.col(weight).cast("double").between(low, high), F.lit(False))
    r = r.observe(obs, F.count(F.lit(1)).alias("rows"), F.count("no").alias("matched"),
                  F.count_if(~inside).alias("outside_range"), F.count_if(inside).alias("new"), *unfit)
    return conform(r, loaded_at).where(F.col("weight_kg").between(low, high)), obs


def _observed(obs: Observation) -> dict[str, int]:
    """What the pass counted; where the planner saw that there are no rows it took the count away with the plan."""
    try:
        return dict(obs.get)
    except Py4JJavaError:
        return dict.fromkeys(("rows", "matched", "outside_range", "new"), 0)


def finish_rows(rows: DataFrame, herd: DataFrame | None, label: str, loaded_at, master_path: str, write: bool = True) -> Run:
    """Tail, upsert and gate of parsed rows, in one pass over them.

    The join-rate gate looks at the rows right after the merge, before class and range filter; its numbers
    and all counts come from the observation that the pass takes. Where cleaning leaves no row the run is
    ``failed`` and the master stays as it is. A dry run counts as well and writes nothing.
    """
    tail, obs = counted_tail(rows, herd, loaded_at)
    done = upsert_days(tail, master_path, write=write)
    if not write:
        tail.write.format("noop").mode("overwrite").save()      # the pass that a dry run's counts come from
    counts = _observed(obs)
    if not counts["rows"]:
        return Run("failed", done.table, counts, "skipped", label)
    counts["master"] = done.table.count() if write else counts["new"]
    return Run("completed", done.table, counts, join_rate_status(counts["rows"], counts["matched"]), label, done.days)


def _finish(rows: DataFrame, today_herd: DataFrame | None, snapshots: DataFrame | None, as_of, loaded_at,
            master_path: str, write: bool) -> Run:
    """Herd by precedence, then `finish_rows`."""
    herd, label = resolve_herd(today_herd, snapshots, as_of)
    return finish_rows(rows, herd, label, loaded_at, master_path, write)


def blob_run_full(spark: SparkSession, raw: dict[str, DataFrame], landing_path: str, master_path: str, loaded_at,
                  today: dt.date, mode: str = "full", enabled: list[str] | None = None,
                  today_herd: DataFrame | None = None, snapshots: DataFrame | None = None, as_of=None,
                  date_from=None, date_to=None, write: bool = True) -> Run:
    """The blob job over all enabled devices.

    ``land`` lands the fetched records and stops; ``replay`` reads the landed blobs of its window;
    ``full`` does both. Without records the run is ``no_new_data`` and writes nothing further.
    """
    if mode not in ("land", "replay", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "replay":
        lo, hi = load_window(today, date_from, date_to, "replay")
        blobs = read_raw_blobs(spark, landing_path, lo, hi, enabled)
    else:
        blobs = tag_and_union(raw, "PTM", enabled)
    if blobs is None or not expect_non_empty(blobs):
        return Run("no_new_data")
    if mode != "replay":
        for device, df in raw.items():
            if enabled is None or device in enabled:
                land_raw(df, landing_path, device, write=write)
    if mode == "land":
        return Run("landed", blobs)
    return _finish(blob_rows(blobs), today_herd, snapshots, as_of, loaded_at, master_path, write)


def session_run_full(spark: SparkSession, listing: DataFrame | None, documents: DataFrame | None, path: str,
                     master_path: str, loaded_at, today: dt.date, mode: str = "full",
                     today_herd: DataFrame | None = None, snapshots: DataFrame | None = None, as_of=None,
                     date_from=None, date_to=None, write: bool = True) -> Run:
    """The session job: listed sessions that are not landed yet, their documents (session_id and the
    document's fields), landing, then the tail. Modes as in `blob_run_full`; ``replay`` reads the
    landed animals of its window."""
    if mode not in ("land", "replay", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "replay":
        lo, hi = load_window(today, date_from, date_to, "replay")
        rows = spark.read.parquet(f"{path}/animals").where(
            (F.col("session_month") >= f"{lo:%Y-%m}") & (F.col("session_month") <= f"{hi:%Y-%m}")
            & F.col("date").between(F.lit(str(lo)), F.lit(str(hi))))
        if not expect_non_empty(rows):
            return Run("no_new_data")
        rows = _typed(rows.drop("session_date", "session_month"))
        return _finish(rows, today_herd, snapshots, as_of, loaded_at, master_path, write)
    landed = _landed_ids(spark, path)
    new = new_sessions(listing, landed)
    if not expect_non_empty(new):
        return Run("no_new_data")
    docs = documents.join(new.select("session_id"), "session_id", "left_semi")
    from herdflow.sources.sessions import flatten_sessions
    flat = flatten_sessions(docs)
    if mode == "land":
        return Run("landed", land_sessions(new.drop("session_id"), flat, path, write)[1])
    run = _finish(session_rows(docs), today_herd, snapshots, as_of, loaded_at, master_path, write)
    land_sessions(new.drop("session_id"), flat, path, write)       # last: a failed tail fetches them again
    return run


def _typed(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("date", F.try_to_date(F.col("date"), "yyyy-MM-dd"))
            .withColumn("source", F.lit("GALLAGHER")).withColumn("device", F.lit("GALLAGHER_1")))


def _landed_ids(spark: SparkSession, path: str) -> DataFrame:
    from herdflow.functions.text import session_id
    from herdflow.sinks.master import has_data
    if not has_data(spark, f"{path}/sessions", "session_month"):
        return spark.createDataFrame([], "session_id bigint")
    return spark.read.parquet(f"{path}/sessions").select(session_id("href").alias("session_id"))


def run_steps(spark: SparkSession, steps: list[tuple[str, str, Callable[[], object]]], log_path: str | None = None,
              write: bool = True) -> DataFrame:
    """Run (job, device, function) steps in order; one that fails does not stop the others.

    A step that returns a `Run` gives its status and counts, anything else counts as completed.
    Returns (and appends to the log) one row a step.
    """
    rows = []
    for job, device, fn in steps:
        t0 = time.time()
        try:
            out = fn()
            status, msg = (out.status, out.message) if isinstance(out, Run) else ("completed", "")
        except Exception as e:  # noqa: BLE001 - one job failing must not stop the run
            status, msg = "failed", str(e) or type(e).__name__
        rows.append((job, device, status, round(time.time() - t0, 2), msg))
    if log_path and write:
        return append_run_log(spark, log_path, rows)
    return spark.createDataFrame(rows, "job_name string, device string, status string, duration double, msg string")


def daily(spark: SparkSession, weigh: list[tuple[str, str, Callable[[], object]]], read_master: Callable[[], DataFrame],
          herd: DataFrame, today: dt.date, export_path: str | None = None, log_path: str | None = None,
          write: bool = True) -> tuple[DataFrame, dict[str, dict[str, DataFrame]]]:
    """The daily run: weigh jobs, the CSV export if one of them completed, freshness, and the reports:
    daily always, weekly on Fridays, month on a month's last day. Returns (status rows, reports)."""
    first = run_steps(spark, weigh)
    done = first.where("status = 'completed'").count() > 0
    reports: dict[str, dict[str, DataFrame]] = {}

    def export() -> object:
        if not done or export_path is None:
            return Run("skipped")
        export_csv(read_master(), export_path, ["date", "device", "ear_tag"], write)
        return None

    def fresh() -> Run:
        row = freshness(read_master(), today).first()
        return Run("alert" if row["alert"] else "completed", counts={"gap_days": row["gap_days"]})

    def report(name: str, due: bool, make: Callable[[], dict[str, DataFrame]]) -> Callable[[], object]:
        def fn() -> object:
            if not due:
                return Run("skipped")
            reports[name] = make()
            return None
        return fn

    last_day = (today + dt.timedelta(days=1)).day == 1
    second = run_steps(spark, [
        ("export", "", export), ("freshness", "", fresh),
        ("daily_report", "", report("daily", True, lambda: daily_report(read_master(), today))),
        ("weekly_report", "", report("weekly", today.weekday() == 4, lambda: weekly_report(read_master(), herd, today))),
        ("month_report", "", report("month", last_day, lambda: month_report(read_master(), herd, today.replace(day=1), today)))])
    rows = [(r["job_name"], r["device"], r["status"], r["duration"], r["msg"]) for r in (*first.collect(), *second.collect())]
    if log_path and write:
        return append_run_log(spark, log_path, rows), reports
    return spark.createDataFrame(rows, first.schema), reports


def month_bundle(master: DataFrame, herd: DataFrame, month_start: dt.date, month_end: dt.date, path: str,
                 raw: dict[str, DataFrame] | None = None, produced_at=None, write: bool = True) -> tuple[dict[str, DataFrame], str]:
    """The month's tables, the parsed raw rows of each source (`raw`) and the rows left after each
    stage, written in one bundle; returns the tables and the name of the import file.

    The month's rows of the master are computed once, into the scratch folder, and all tables are made from these; a dry
    run stays lazy and writes nothing."""
    if write:
        master = staged(master.where((F.col("date") >= F.lit(month_start)) & (F.col("date") <= F.lit(month_end))), "month-rows")
    frames = dict(month_report(master, herd, month_start, month_end, produced_at))
    order = ["date", "device", "ear_tag"]
    for name in ("clean_csv", "clean_re_outlier"):
        frames[name] = frames[name].orderBy(*order)
    for name, df in (raw or {}).items():
        frames[f"raw_{name}"] = df
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    stages = [(name, frames[name]) for name in [*(f"raw_{k}" for k in raw or {}), "clean_csv", "clean_re_outlier"]]
    out = None
    for name, df in stages:
        row = count(df).select(F.lit(name).alias("stage"), "n")
        out = row if out is None else out.unionAll(row)
    frames["stage_counts"] = out
    return frames, write_month_bundle(frames, path, f"{month_start:%Y%m}", write)
