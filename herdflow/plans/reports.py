"""Report tables: daily, weekly coverage and the month-end bundle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdflow.functions.classify import classify
from herdflow.operators.aggregates import (curve, day_counts, histogram, month_headline,
                                           top_groups)
from herdflow.operators.bands import (coverage_status, coverage_summary, month_groups,
                                      month_meta, month_summary, weekly_coverage)
from herdflow.operators.conform import filter_range
from herdflow.schemas import MONTH_OUTLIER_HIGH, MONTH_OUTLIER_LOW


def _by_first(table: DataFrame) -> DataFrame:
    """A report's rows in the order of its first column."""
    return table.orderBy(table.columns[0])


def daily_report(master: DataFrame, day: dt.date) -> dict[str, DataFrame]:
    """Day counts, top groups, heifer curve by rounded age, cow curve by DIM and weight
    histograms by class for one day (classes recomputed from no + lac_no). On a day when
    neither class has weights there is one histogram over all rows, its class ``all``."""
    d = (master.where(F.col("date") == F.lit(day))
         .withColumn("animal_type", classify("no", "lac_no")))
    heifer = d.where(F.col("animal_type") == "heifer")
    cow = d.where(F.col("animal_type") == "cow")
    classes = d.where(F.col("animal_type").isin("cow", "heifer"))
    if classes.where(F.col("weight_kg").isNotNull()).isEmpty():
        classes = d.withColumn("animal_type", F.lit("all"))
    return {
        "counts": day_counts(d, by="date"),
        "top_groups": top_groups(d),
        "heifer_curve": _by_first(curve(heifer, "age_month", round_digits=0)),
        "cow_curve": _by_first(curve(cow, "dim")),
        "histogram": histogram(classes, "weight_kg", by="animal_type"),
    }


def weekly_report(master: DataFrame, herd: DataFrame, today: dt.date) -> dict[str, DataFrame]:
    cov = weekly_coverage(master, herd, today)
    return {"coverage": cov, "summary": coverage_summary(cov), "status": coverage_status(cov)}


def month_report(master: DataFrame, herd: DataFrame, month_start: dt.date, month_end: dt.date,
                 produced_at=None) -> dict[str, DataFrame]:
    """Month-end tables: clean rows, rows without outliers, coverage summary + meta,
    group coverage and headline numbers."""
    period = master.where((F.col("date") >= F.lit(month_start)) & (F.col("date") <= F.lit(month_end))
                          & F.col("weight_kg").isNotNull())
    clean = filter_range(period, "weight_kg", MONTH_OUTLIER_LOW, MONTH_OUTLIER_HIGH)
    return {
        "clean_csv": period,
        "clean_re_outlier": clean,
        "summary": month_summary(master, herd, month_start, month_end),
        "meta": month_meta(herd, month_start, month_end, produced_at or dt.datetime.now().replace(microsecond=0)),
        "groups": month_groups(master, herd, month_start, month_end),
        "headline": month_headline(period),
    }
