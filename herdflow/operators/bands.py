"""Band range join, headcount baseline, weighed stats and coverage.

A row meets every band whose bounds hold its value, in an equi-join on bins (`band_join`), so a band
table may have three rows or millions and its bands may overlap at will. Overlapping bands count a row
in each band that contains it; bands without rows are still reported (bands left-join the aggregates).
Where only totals of each band are asked for, no pair is made: bands add up the totals of runs of values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.schemas import MONTHLY_THRESHOLD, WEEK_THRESHOLDS, monthly_bands, weekly_bands
from herdflow.session import staged
from herdflow.sources.snapshots import pick_snapshot, snapshot_date


def prefixed(bands: DataFrame, prefix: str = "b_") -> DataFrame:
    return bands.select(*[F.col(c).alias(prefix + c) for c in bands.columns])


@dataclass(frozen=True)
class Span:
    """The range of a band join: a row's `value` against the bands' `low` and `high` columns, both bounds
    inclusive or not as the join's condition says; where there is none, as `low_in` and `high_in` say.
    `bands` picks the bands it is for (all without one)."""

    value: str
    low: str
    high: str
    bands: str | None = None
    low_in: bool = True
    high_in: bool = True


#: Exponents of the widths of bins. A band wider than the last, or without an end, has one bin for all values.
LEAST_LEVEL, MOST_LEVEL = -30, 60


def _level(low: Column, high: Column) -> Column:
    """The smallest power of two that is as wide as the band: the band touches two bins of that width at most."""
    width = high.cast("double") - low.cast("double")
    level = F.ceil(F.log2(F.greatest(width, F.lit(2.0 ** LEAST_LEVEL)))).cast("int")
    # beyond 2^52 bins from 0, neighbouring bins are no longer told apart
    far = F.greatest(F.abs(low.cast("double")), F.abs(high.cast("double")))
    level = F.greatest(level, F.when(far > 0, F.ceil(F.log2(far)).cast("int") - 50).otherwise(LEAST_LEVEL))
    open_ = ~(F.coalesce(far < F.lit(float("inf")), F.lit(False)) & ~F.isnan(far))
    return F.when(open_ | (level > MOST_LEVEL), MOST_LEVEL + 1).otherwise(level)


def _bin(value: Column, level: Column) -> Column:
    """The number of the bin of that level that holds the value."""
    inside = F.floor(value.cast("double") / F.pow(F.lit(2.0), level.cast("double")))
    return F.when(level > MOST_LEVEL, F.lit(0)).otherwise(inside).cast("long")


def _span_join(df: DataFrame, bands: DataFrame, span: Span, cond: Column) -> DataFrame:
    low, high = F.col(span.low), F.col(span.high)
    own = bands if span.bands is None else bands.where(span.bands)
    own = own.where(low.cast("double") <= high.cast("double")).withColumn("_level", _level(low, high))
    first, last = _bin(low, F.col("_level")), _bin(high, F.col("_level"))
    binned = own.withColumn("_bin", F.explode(F.sequence(first, last)))
    levels = sorted(r["_level"] for r in own.select("_level").distinct().collect())   # at most one an exponent
    value = F.col(span.value).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value))
    keyed = known.withColumn("_l", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    keyed = keyed.withColumn("_b", _bin(value, F.col("_l")))
    return keyed.join(binned, (F.col("_l") == F.col("_level")) & (F.col("_b") == F.col("_bin")) & cond).drop("_l", "_b", "_level", "_bin")


def band_join(df: DataFrame, bands: DataFrame, cond: Column | None, spans: list[Span],
              totals: dict[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """Every (row, band) pair whose condition holds, each once; `bands` carry the prefix ``b_``.

    Each band belongs to one of the `spans`, and `cond` must hold only between its bounds. A band is put
    in the bins it touches of the power of two that is as wide as the band (two at most), a row in one bin
    of each width there is; they are joined by equality of (width, bin) and `cond` is tested on the pairs.
    So the join is a hash or sort-merge join: nothing is refused or broadcast by assumption, and a bin that
    many rows share can be split. Bands with a null bound and rows with a null value (or NaN) have no pairs.

    With `totals` (name -> ("count" | "sum" | "min" | "max", column of `df`)) and no `cond`, every band that has
    pairs comes once, with the totals of its rows, and no pair is made (`_span_totals`): the work grows with rows
    and bands, not with the pairs, of which many wide bands over many rows have the product.
    """
    if totals is not None and cond is not None:
        raise ValueError("totals take the rows between the bounds: leave the condition out")
    out = None
    for span in spans:
        part = _span_join(df, bands, span, cond) if totals is None else _span_totals(df, bands, span, totals)
        out = part if out is None else out.unionByName(part)
    return out


#: Neighbouring runs of values that one run of the next level holds, as a power of two.
RUN_BITS = 2


def _merged(totals: dict[str, tuple[str, str | None]]) -> list[Column]:
    """Totals of totals."""
    return [getattr(F, "sum" if kind == "count" else kind)(name).alias(name) for name, (kind, _) in totals.items()]


def _span_totals(df: DataFrame, bands: DataFrame, span: Span, totals: dict[str, tuple[str, str | None]]) -> DataFrame:
    """The bands of the span with the totals of their rows.

    Distinct values and distinct bounds are sorted together, which gives each its place. Runs of 1, 4, 16, ... places
    have the totals of their values; the places between a band's bounds are cut into the longest such runs, at
    most six of a length, and these are joined by equality. So a band costs the logarithm of the places.
    """
    low, high = F.col(span.low), F.col(span.high)
    own = (bands if span.bands is None else bands.where(span.bands)).where(low <= high)
    ranges = own.select(low.alias("_low"), high.alias("_high")).distinct()
    value = F.col(span.value)
    first = [(F.count(F.lit(1)) if kind == "count" else getattr(F, kind)(of)).alias(name) for name, (kind, of) in totals.items()]
    values = df.where(value.isNotNull() & ~F.isnan(value.cast("double"))).groupBy(value.alias("_at")).agg(*first)
    # at one value: bounds before it, the value, bounds after it
    edges = (ranges.select(F.col("_low").alias("_at"), F.lit(0 if span.low_in else 2).alias("_side"))
             .unionAll(ranges.select("_high", F.lit(2 if span.high_in else 0))).distinct())
    points = values.withColumn("_side", F.lit(1)).unionByName(edges, allowMissingColumns=True)
    points = staged(points, "band-points").repartitionByRange("_at", "_side").sortWithinPartitions("_at", "_side")
    points = staged(points.withColumn("_id", F.monotonically_increasing_id()), "band-places")
    part = F.shiftright("_id", 33)
    starts, n = [], 0
    for r in sorted(points.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):     # a row a partition
        starts.append((r["p"], n))
        n += r["n"]
    starts = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    placed = (points.withColumn("_part", part).join(F.broadcast(starts), "_part")
              .withColumn("_place", F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1)))
    ends = placed.where("_side <> 1").select("_at", "_side", "_place")

    def end(side: int, bound: str, name: str) -> DataFrame:
        return ends.where(F.col("_side") == side).select(F.col("_at").alias(bound), F.col("_place").alias(name))

    cut = (ranges.join(end(0 if span.low_in else 2, "_low", "_a"), "_low").join(end(2 if span.high_in else 0, "_high", "_b"), "_high"))

    single = placed.where("_side = 1").select(F.lit(0).alias("_level"), F.col("_place").alias("_run"), *totals)
    runs = staged(single.groupBy(F.shiftright("_run", RUN_BITS).alias("_run")).agg(*_merged(totals)), "band-runs")
    top = max(1, -(-n.bit_length() // RUN_BITS))
    levels = F.explode(F.sequence(F.lit(1), F.lit(top))).alias("_level")
    higher = (runs.select(levels, "*").withColumn("_run", F.expr(f"shiftright(_run, {RUN_BITS} * (_level - 1))"))
              .groupBy("_level", "_run").agg(*_merged(totals)))

    def pieces(k: int) -> Column:
        """The runs of level k that runs of the next do not hold."""
        up = lambda k: F.shiftright(F.col("_a") + ((1 << RUN_BITS * k) - 1), RUN_BITS * k)
        down = lambda k: F.shiftright("_b", RUN_BITS * k)                                    # noqa: E731
        between = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
        a, b, a2, b2 = up(k), down(k), up(k + 1), down(k + 1)
        both = F.concat(between(a, F.shiftleft(a2, RUN_BITS)), between(F.shiftleft(b2, RUN_BITS), b))
        return F.transform(F.when(a2 < b2, both).otherwise(between(a, b)), lambda r: F.struct(F.lit(k).alias("_level"), r.alias("_run")))

    held = cut.select("_low", "_high", F.inline(F.concat(*[pieces(k) for k in range(top + 1)])))
    # values and their runs apart: only the lowest level is as long as the table
    met = (held.where("_level = 0").join(single, ["_level", "_run"])
           .unionByName(held.where("_level > 0").join(higher, ["_level", "_run"])))
    found = met.groupBy("_low", "_high").agg(*_merged(totals))
    return own.join(found, (low == F.col("_low")) & (high == F.col("_high"))).drop("_low", "_high")


def band_count(snapshot: DataFrame, bands: DataFrame, cond: Column, spans: list[Span], out: str = "baseline") -> DataFrame:
    """Headcount per band (``b_label``) on one snapshot; empty bands get 0."""
    agg = band_join(snapshot, bands, cond, spans).groupBy("b_label").agg(F.count(F.lit(1)).alias(out))
    return (bands.select("b_ord", "b_label").join(agg, "b_label", "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("bigint")))


def band_stats(df: DataFrame, bands: DataFrame, cond: Column, spans: list[Span], no_col: str = "no",
               weight_col: str = "weight_kg") -> DataFrame:
    """Per band: distinct animals, mean weight (unrounded), row count; empty bands -> 0 / null."""
    agg = (band_join(df, bands, cond, spans).groupBy("b_label")
           .agg(F.countDistinct(no_col).alias("weighed"),
                F.avg(weight_col).alias("avg_raw"),
                F.count(F.lit(1)).alias("n_valid")))
    return (bands.select("b_ord", "b_label").join(agg, "b_label", "left")
            .withColumn("weighed", F.coalesce("weighed", F.lit(0)).cast("bigint"))
            .withColumn("n_valid", F.coalesce("n_valid", F.lit(0)).cast("bigint")))


def coverage(weighed: Column, baseline: Column) -> Column:
    """weighed / baseline * 100; 0 when the baseline is 0."""
    return F.when(baseline > 0, weighed / baseline * 100).otherwise(F.lit(0.0))


def week_threshold(today: dt.date) -> float:
    week = (today.day - 1) // 7 + 1
    return WEEK_THRESHOLDS[min(week, 3)]


# --------------------------------------------------------------------------- weekly
def _weekly_spans(age_col: str, kind: str) -> list[Span]:
    return [Span(age_col, f"b_{kind}_min", f"b_{kind}_max")]


def _weekly_cond_baseline(age_col: str) -> Column:
    a = F.col(age_col)
    return (a >= F.col("b_baseline_min")) & (a <= F.col("b_baseline_max"))


def _weekly_cond_weighed(age_col: str, weight_col: str) -> Column:
    a, w = F.col(age_col), F.col(weight_col)
    return ((a >= F.col("b_weight_min")) & (a <= F.col("b_weight_max"))
            & (w >= F.col("b_outlier_low")) & (w <= F.col("b_outlier_high")))


def weekly_coverage(master: DataFrame, herd: DataFrame, today: dt.date,
                    bands: DataFrame | None = None, herd_date: str = "date",
                    herd_age: str = "age_month_fix", no_col: str = "no") -> DataFrame:
    """Weekly heifer coverage per age band.

    Baseline: the herd snapshot dated on or after the first of the month (earliest such,
    possibly in a later month), counted by ``age_month_fix`` band. Weighed: master rows
    from the first of the month to `today`, heifers with a herd number, age and weight
    inside the band (all bounds inclusive). Coverage is compared to the week's threshold
    unrounded; the reported percentage and mean weight are rounded half-even to 1 decimal.
    """
    spark = master.sparkSession
    b = prefixed(bands) if bands is not None else week_bands(spark)
    period = master.where((F.col("date") >= F.lit(today.replace(day=1))) & (F.col("date") <= F.lit(today))
                          & (F.col("animal_type") == "heifer") & F.col(no_col).isNotNull())
    stats = band_stats(period, b, week_cond(), week_spans(), no_col)
    return week_result(b, herd, stats, today, herd_date, herd_age)


def week_bands(spark: SparkSession) -> DataFrame:
    return prefixed(weekly_bands(spark))


def week_cond() -> Column:
    """Rows that count as weighed in a weekly band."""
    return _weekly_cond_weighed("age_month", "weight_kg")


def week_spans() -> list[Span]:
    return _weekly_spans("age_month", "weight")


def week_result(b: DataFrame, herd: DataFrame, stats: DataFrame, today: dt.date, herd_date: str = "date",
                herd_age: str = "age_month_fix") -> DataFrame:
    """The weekly report of the bands' stats (`band_stats`, or merged day states) and the baseline."""
    snap = pick_snapshot(herd, herd_date, today.replace(day=1), "forward")
    base = band_count(snap, b, _weekly_cond_baseline(herd_age), _weekly_spans(herd_age, "baseline"))
    thr = week_threshold(today)
    cov = coverage(F.col("weighed"), F.col("baseline"))
    return (b.join(base.drop("b_ord"), "b_label")
            .join(stats.drop("b_ord"), "b_label")
            .select(F.col("b_ord").alias("ord"), F.col("b_label").alias("label"),
                    "baseline", "weighed",
                    F.bround(cov, 1).alias("coverage_pct"),
                    (cov >= F.lit(thr)).alias("flag_ok"),
                    F.when(F.col("avg_raw") != 0, F.bround("avg_raw", 1)).alias("avg_weight"),
                    "n_valid",
                    F.col("b_outlier_low").alias("outlier_low"),
                    F.col("b_outlier_high").alias("outlier_high"),
                    F.lit(thr).alias("threshold_pct")))


def coverage_summary(cov: DataFrame) -> DataFrame:
    """One row: total weighed, any band below threshold, below-threshold labels in band order.

    The label list is gathered from the band-level table (one row per band), so its size
    is bounded by the band table, not by the data.
    """
    below = F.when(~F.col("flag_ok"), F.struct(F.col("ord"), F.col("label")))
    return cov.agg(
        F.sum("weighed").cast("bigint").alias("total_weighed"),
        F.coalesce(F.bool_or(~F.col("flag_ok")), F.lit(False)).alias("has_warning"),
        F.transform(F.array_sort(F.collect_list(below)), lambda s: s["label"]).alias("warning_groups"),
    )


def coverage_status(cov: DataFrame) -> DataFrame:
    """Three-level status per band and progress-bar fill (percentage capped at 100)."""
    return cov.select(
        "ord", "label", "coverage_pct", "flag_ok",
        F.when(F.col("flag_ok"), F.lit("ok"))
        .when(F.col("coverage_pct") >= F.col("threshold_pct") * 0.5, F.lit("warn"))
        .otherwise(F.lit("bad")).alias("status"),
        F.least(F.col("coverage_pct"), F.lit(100.0)).cast("int").alias("fill_pct"),
    )


# -------------------------------------------------------------------------- monthly
def _month_period(master: DataFrame, start: dt.date, end: dt.date, no_col: str) -> DataFrame:
    return master.where((F.col("date") >= F.lit(start)) & (F.col("date") <= F.lit(end))
                        & F.col(no_col).isNotNull())


def _monthly_result(b: DataFrame, base: DataFrame, stats: DataFrame) -> DataFrame:
    cov = F.bround(coverage(F.col("weighed"), F.col("baseline")), 1)
    avg = F.round("avg_raw", 1)
    return (b.join(base.drop("b_ord"), "b_label")
            .join(stats.drop("b_ord"), "b_label")
            .select(F.col("b_ord").alias("ord"), F.col("b_label").alias("label"),
                    "baseline", "weighed", cov.alias("coverage"),
                    (cov >= F.lit(MONTHLY_THRESHOLD)).alias("ok"),
                    F.when(avg != 0, avg).alias("avg_w"), "n_valid"))


def month_summary(master: DataFrame, herd: DataFrame, month_start: dt.date, month_end: dt.date,
                  herd_date: str = "date", herd_age: str = "age_month_fix",
                  no_col: str = "no") -> DataFrame:
    """Monthly heifer coverage with the weekly bands: fixed 30 % threshold compared to the
    coverage rounded to 1 decimal; mean weight rounded half-up (SQL ROUND)."""
    spark = master.sparkSession
    b = prefixed(weekly_bands(spark))
    snap = pick_snapshot(herd, herd_date, month_start, "forward")
    base = band_count(snap, b, _weekly_cond_baseline(herd_age), _weekly_spans(herd_age, "baseline"))
    period = _month_period(master, month_start, month_end, no_col).where(F.col("animal_type") == "heifer")
    stats = band_stats(period, b, _weekly_cond_weighed("age_month", "weight_kg"), _weekly_spans("age_month", "weight"), no_col)
    return _monthly_result(b, base, stats)


def month_meta(herd: DataFrame, month_start: dt.date, month_end: dt.date, produced_at,
               herd_date: str = "date") -> DataFrame:
    """Meta rows of the month summary: period, threshold, baseline date, produced-at."""
    sd = snapshot_date(herd, herd_date, month_start, "forward")
    period = f"{month_start.isoformat()} → {month_end.isoformat()}"
    return sd.select(F.explode(F.array(
        F.struct(F.lit("period").alias("item"), F.lit(period).alias("value")),
        F.struct(F.lit("threshold").alias("item"), F.lit(f"{MONTHLY_THRESHOLD}%").alias("value")),
        F.struct(F.lit("baseline_date").alias("item"),
                 F.coalesce(F.col("snap_date").cast("string"), F.lit("N/A")).alias("value")),
        F.struct(F.lit("produced_at").alias("item"), F.lit(str(produced_at)).alias("value")),
    )).alias("m")).select("m.*")


def _monthly_spans(age_col: str) -> list[Span]:
    """Heifer bands go by age, all others by days in milk."""
    return [Span(age_col, "b_age_min", "b_age_max", "b_type = 'heifer'"),
            Span("dim", "b_dim_min", "b_dim_max", "NOT (b_type <=> 'heifer')")]


def _monthly_cond_baseline() -> Column:
    heifer = (F.col("age_month_fix") >= F.col("b_age_min")) & (F.col("age_month_fix") < F.col("b_age_max"))
    cow = ((F.col("lac_no") >= F.col("b_lac_min")) & (F.col("lac_no") <= F.col("b_lac_max"))
           & (F.col("dim") >= F.col("b_dim_min")) & (F.col("dim") < F.col("b_dim_max")))
    return F.when(F.col("b_type") == "heifer", heifer).otherwise(cow)


def _monthly_cond_weighed() -> Column:
    heifer = ((F.col("animal_type") == "heifer") & (F.col("age_month") >= F.col("b_age_min"))
              & (F.col("age_month") < F.col("b_age_max")))
    cow = ((F.col("animal_type") == "cow")
           & (F.col("lac_no") >= F.col("b_lac_min")) & (F.col("lac_no") <= F.col("b_lac_max"))
           & (F.col("dim") >= F.col("b_dim_min")) & (F.col("dim") < F.col("b_dim_max")))
    w = F.col("weight_kg")
    return (F.when(F.col("b_type") == "heifer", heifer).otherwise(cow)
            & (w >= F.col("b_w_low")) & (w <= F.col("b_w_high")))


def month_groups(master: DataFrame, herd: DataFrame, month_start: dt.date, month_end: dt.date,
                 herd_date: str = "date", no_col: str = "no") -> DataFrame:
    """Monthly cow/heifer group coverage (age and DIM upper-exclusive, lac_no inclusive)."""
    b = month_bands(master.sparkSession)
    stats = band_stats(_month_period(master, month_start, month_end, no_col), b, month_cond(), month_spans(), no_col)
    return month_groups_result(b, herd, stats, month_start, herd_date)


def month_bands(spark: SparkSession) -> DataFrame:
    return prefixed(monthly_bands(spark))


def month_cond() -> Column:
    """Rows that count as weighed in a monthly group."""
    return _monthly_cond_weighed()


def month_spans() -> list[Span]:
    return _monthly_spans("age_month")


def month_groups_result(b: DataFrame, herd: DataFrame, stats: DataFrame, month_start: dt.date, herd_date: str = "date") -> DataFrame:
    """The monthly group report of the groups' stats (`band_stats`, or merged day states) and the baseline."""
    snap = pick_snapshot(herd, herd_date, month_start, "forward")
    base = band_count(snap, b, _monthly_cond_baseline(), _monthly_spans("age_month_fix"))
    return _monthly_result(b, base, stats)
