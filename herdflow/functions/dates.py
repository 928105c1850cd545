"""Date scalars: blob dates, file-name dates, calendar helpers, back-dating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from herdflow.functions.text import col_, strip_ws
from herdflow.schemas import AGE_MONTH_DAYS, WEEK_THRESHOLDS


def parse_dmy(c: Column | str) -> Column:
    """``D/M/YYYY`` (one or two digit day/month) -> date; invalid -> null, row kept."""
    return F.try_to_date(strip_ws(c), "d/M/yyyy")


def file_date(name: Column | str) -> Column:
    """Date carried by a landed file name.

    ``direct_YYYY-MM-DD`` is tried first (an invalid date there gives null), otherwise
    ``<seq>-DDMMYYYY_<seq>``; no match -> null.
    """
    n = col_(name)
    iso = F.regexp_extract(n, r"direct_(\d{4}-\d{2}-\d{2})", 1)
    pat = r"\d+-(\d{2})(\d{2})(\d{4})_\d+"
    dmy = F.concat_ws("-", F.regexp_extract(n, pat, 3), F.regexp_extract(n, pat, 2),
                      F.regexp_extract(n, pat, 1))
    return (F.when(iso != "", F.try_to_date(iso, "yyyy-MM-dd"))
            .when(F.regexp_extract(n, pat, 0) != "", F.try_to_date(dmy, "yyyy-MM-dd")))


def year_month(d: Column | str) -> Column:
    return F.date_format(col_(d), "yyyy-MM")


def month_start(d: Column | str) -> Column:
    return F.trunc(col_(d), "MM")


def month_end(d: Column | str) -> Column:
    return F.last_day(col_(d))


def is_month_end(d: Column | str) -> Column:
    return col_(d) == F.last_day(col_(d))


def week_of_month(d: Column | str) -> Column:
    """(day - 1) div 7 + 1."""
    return (F.floor((F.dayofmonth(col_(d)) - 1) / 7) + 1).cast("int")


def coverage_threshold(week: Column | str) -> Column:
    """Minimum coverage % for a week of the month (10 / 20 / 30 for week 1 / 2 / >= 3)."""
    w = col_(week)
    return (F.when(w <= 1, F.lit(WEEK_THRESHOLDS[1]))
            .when(w == 2, F.lit(WEEK_THRESHOLDS[2]))
            .otherwise(F.lit(WEEK_THRESHOLDS[3])))


def day_diff(snapshot_date: Column | str, d: Column | str) -> Column:
    """snapshot date - weigh date in days; null for a null date."""
    return F.datediff(col_(snapshot_date), col_(d))


def age_month(age_days: Column | str) -> Column:
    """round(age_days / 30.44, 1)."""
    return F.round(col_(age_days).cast("double") / F.lit(AGE_MONTH_DAYS), 1)


def fmt_date(d: Column | str, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(col_(d), pattern)


def fmt_pct(x: Column | str) -> Column:
    """Percentage with one decimal, e.g. ``29.9%``."""
    return F.concat(F.format_string("%.1f", F.bround(col_(x), 1)), F.lit("%"))
