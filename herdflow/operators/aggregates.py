"""Report aggregates: per month and animal, day counts, top groups, curves, histogram,
freshness, headline numbers and value counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.schemas import (MASTER_ORDER, MONTH_OUTLIER_HIGH, MONTH_OUTLIER_LOW,
                              NO_DATA_ALERT_DAYS, WEIGHT_HIGH, WEIGHT_LOW)


def monthly_by_key(df: DataFrame, key: str = "no", date_col: str = "date",
                   weight_col: str = "weight_kg", low: float = WEIGHT_LOW, high: float = WEIGHT_HIGH,
                   order: list[str] = MASTER_ORDER) -> DataFrame:
    """One row per (year_month, key) for rows with a key.

    weight = mean of the weights inside [low, high] only (a month with only outliers
    keeps its row with a null weight), rounded half-even to 1 decimal; max of age_month
    (rounded 1), age_days, dim, lac_no; group_name / animal_type = the last non-null value
    in master order. Partial aggregation keeps a hot key cheap.
    """
    ord_key = "struct(" + ", ".join(f"`{c}`" for c in order) + ")"
    w = F.col(weight_col)
    return (df.where(F.col(key).isNotNull())
            .withColumn("year_month", F.date_format(F.col(date_col), "yyyy-MM"))
            .groupBy("year_month", key)
            .agg(F.bround(F.avg(F.when(w.between(low, high), w)), 1).alias(weight_col),
                 F.bround(F.max("age_month"), 1).alias("age_month"),
                 F.max("age_days").cast("smallint").alias("age_days"),
                 F.max("dim").cast("smallint").alias("dim"),
                 F.max("lac_no").cast("smallint").alias("lac_no"),
                 F.expr(f"max_by(group_name, {ord_key}) FILTER (WHERE group_name IS NOT NULL)").alias("group_name"),
                 F.expr(f"max_by(animal_type, {ord_key}) FILTER (WHERE animal_type IS NOT NULL)").alias("animal_type")))


def refresh_months(master: DataFrame, path: str, days: list[str | None], key: str = "no") -> list[str]:
    """Bring the table of `monthly_by_key` under `path` (a folder a month) up to date after an upsert that
    touched `days`: only their months are read from the day-partitioned `master`, recomputed and replaced.
    Rows without a date are of no month here. Returns the months."""
    from herdflow.sinks.master import refresh_partitions
    months = sorted({d[:7] for d in days if d is not None})
    rows = master.where(F.substring("day", 1, 7).isin(months))
    refresh_partitions(monthly_by_key(rows, key), path, "year_month", months)
    return months


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The kept table of `monthly_by_key`."""
    schema = ("no string, weight_kg double, age_month double, age_days smallint, dim smallint, lac_no smallint, "
              "group_name string, animal_type string, year_month string")
    return spark.read.schema(schema).parquet(path)


def day_counts(df: DataFrame, by: str = "date", cls: str = "animal_type") -> DataFrame:
    """Rows per class (cow / heifer / unknown) and total, per `by` value."""
    c = F.col(cls)
    return df.groupBy(by).agg(
        F.count_if(c == "cow").alias("n_cow"),
        F.count_if(c == "heifer").alias("n_heifer"),
        F.count_if(c == "unknown").alias("n_unknown"),
        F.count(F.lit(1)).alias("n_total"))


def top_groups(df: DataFrame, k: int = 7, group_col: str = "group_name",
               count_col: str = "lac_no") -> DataFrame:
    """Top-k groups by number of rows having `count_col`; null group excluded; ties by name.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its own top k.
    """
    return (df.where(F.col(count_col).isNotNull() & F.col(group_col).isNotNull())
            .groupBy(group_col).agg(F.count(count_col).alias("n"))
            .orderBy(F.col("n").desc(), F.col(group_col).asc())
            .limit(k))


def curve(df: DataFrame, x: str, y: str = "weight_kg", round_digits: int | None = None,
          out_x: str | None = None) -> DataFrame:
    """Mean `y` by `x` (optionally `x` rounded half-even); rows missing x or y are skipped."""
    out_x = out_x or (f"{x}_r" if round_digits is not None else x)
    xe = F.bround(F.col(x), round_digits) if round_digits is not None else F.col(x)
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(xe.alias(out_x)).agg(F.avg(y).alias(f"avg_{y}"), F.count(F.lit(1)).alias("n")))


def _bin_index(x, lo, hi, bins: int):
    return F.least(F.floor((x - lo) * F.lit(bins) / (hi - lo)), F.lit(bins - 1)).cast("int")


def _widen(mn, mx):
    """Range of the data; a single value widens it by 0.5 on each side."""
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    return lo, hi


#: Classes whose ranges are broadcast; more of them are joined.
MAX_CLASSES = 10_000


def histogram(df: DataFrame, col: str, bins: int = 20, by: str | None = None) -> DataFrame:
    """Equal-width histogram between each class's min and max (last bin closed); a single
    value widens the range by 0.5 on each side. Every bin is reported, empty ones with 0.

    With `by`, the per-class range is an aggregate (one row per class, the null class
    included) joined back by null-safe equality and the bins come from that small table with `explode(sequence)`. Without
    `by`, the range is one scalar pair computed first and applied as literals.
    """
    x = F.col(col)
    data = df.where(x.isNotNull() & ~F.isnan(x))
    if by is None:
        r = data.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
        if r["mn"] is None:
            return df.sparkSession.range(0).select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_lo"),
                                                   F.lit(0).cast("bigint").alias("n"))
        mn, mx = float(r["mn"]), float(r["mx"])
        lo, hi = (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)
        counts = (data.groupBy(_bin_index(x, F.lit(lo), F.lit(hi), bins).alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n")))
        all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        return (all_bins.join(F.broadcast(counts), "bin", "left")     # at most `bins` rows
                .select("bin", (F.lit(lo) + F.col("bin") * (F.lit(hi) - F.lit(lo)) / F.lit(bins)).alias("bin_lo"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))
    mm = data.groupBy(by).agg(F.min(x).alias("mn"), F.max(x).alias("mx"))
    lo, hi = _widen(F.col("mn"), F.col("mx"))
    rng = mm.select(F.col(by).alias("_class"), lo.alias("lo"), hi.alias("hi"))
    # one row per class: sent to the executors when that is few, else an ordinary join
    few = rng.limit(MAX_CLASSES + 1).count() <= MAX_CLASSES
    counts = (data.join(F.broadcast(rng) if few else rng, F.col(by).eqNullSafe(F.col("_class")))
              .groupBy("_class", _bin_index(x, F.col("lo"), F.col("hi"), bins).alias("_bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    all_bins = rng.select(F.col("_class").alias(by), "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (all_bins.join(counts, F.col(by).eqNullSafe(F.col("_class")) & (F.col("bin") == F.col("_bin")), "left")
            .select(by, "bin",
                    (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(bins)).alias("bin_lo"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def freshness(df: DataFrame, today: dt.date, limit: int = NO_DATA_ALERT_DAYS,
              date_col: str = "date") -> DataFrame:
    """One row: latest date, gap in days to `today`, alert when the gap exceeds `limit`
    (or when there is no data at all)."""
    return (df.agg(F.max(F.col(date_col).cast("date")).alias("last_date"))
            .select("last_date",
                    F.datediff(F.lit(today), F.col("last_date")).alias("gap_days"))
            .withColumn("alert", F.coalesce(F.col("gap_days") > limit, F.lit(True))))


def month_headline(df: DataFrame, low: float = MONTH_OUTLIER_LOW, high: float = MONTH_OUTLIER_HIGH,
                   no_col: str = "no", weight_col: str = "weight_kg") -> DataFrame:
    """One row: rows, rows with a herd number (not distinct), rows outside [low, high]."""
    inside = F.coalesce(F.col(weight_col).between(low, high), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(no_col).alias("n_with_no"),
                  F.count_if(~inside).alias("n_outliers"))


def value_counts(df: DataFrame, *cols: str, dropna: bool = False) -> DataFrame:
    """Row count per value (combination); nulls kept as a value unless `dropna`."""
    d = df
    if dropna:
        for c in cols:
            d = d.where(F.col(c).isNotNull())
    return d.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
