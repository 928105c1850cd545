"""Band range join and coverage (J6, A1-A7) with the boundary rows of the band tables."""
import datetime as dt
import random

from pyspark.sql import functions as F

from herdflow.operators.bands import (Span, band_join, coverage_status, coverage_summary, month_groups,
                                      month_summary, weekly_coverage)

MASTER = ("date date, no string, animal_type string, age_month double, weight_kg double, "
          "lac_no tinyint, dim smallint")
HERD = "date date, age_month_fix double, lac_no int, dim int"


def _herd(spark, counts, day=dt.date(2024, 5, 1)):
    rows = []
    for age, n in counts:
        rows += [(day, age, 0, None)] * n
    return spark.createDataFrame(rows, HERD)


def test_stored_rendering_example(spark):
    """Week 4 of 05/2026 style report: baselines 159/139/162, nothing weighed -> all flagged."""
    herd = _herd(spark, [(6.0, 159), (9.0, 139), (12.0, 162)])
    master = spark.createDataFrame([], MASTER)
    cov = weekly_coverage(master, herd, dt.date(2024, 5, 27))
    got = {r["label"]: (r["baseline"], r["weighed"], r["coverage_pct"], r["flag_ok"], r["threshold_pct"])
           for r in cov.collect()}
    assert got == {"6 tháng": (159, 0, 0.0, False, 30.0), "9 tháng": (139, 0, 0.0, False, 30.0),
                   "12 tháng": (162, 0, 0.0, False, 30.0)}
    s = coverage_summary(cov).first()
    assert s["total_weighed"] == 0 and s["has_warning"]
    assert s["warning_groups"] == ["6 tháng", "9 tháng", "12 tháng"]
    assert {r["status"] for r in coverage_status(cov).collect()} == {"bad"}


def test_inclusive_upper_bound_and_half_even(spark):
    """Age 6.9 counts in the weekly band; 1/16 -> 6.25 % -> 6.2 (half-even)."""
    herd = _herd(spark, [(6.0, 16)])
    master = spark.createDataFrame([(dt.date(2024, 5, 3), "1", "heifer", 6.9, 200.0, 0, None)], MASTER)
    r = {x["label"]: x for x in weekly_coverage(master, herd, dt.date(2024, 5, 10)).collect()}["6 tháng"]
    assert r["weighed"] == 1 and r["coverage_pct"] == 6.2 and r["threshold_pct"] == 20.0


def test_weekly_unrounded_vs_monthly_rounded_threshold(spark):
    herd = _herd(spark, [(6.0, 2500)])
    master = spark.createDataFrame([(dt.date(2024, 5, 3), str(i), "heifer", 6.0, 200.0, 0, None)
                                    for i in range(749)], MASTER)
    w = {x["label"]: x for x in weekly_coverage(master, herd, dt.date(2024, 5, 27)).collect()}["6 tháng"]
    assert w["coverage_pct"] == 30.0 and w["flag_ok"] is False      # 29.96 < 30
    m = {x["label"]: x for x in month_summary(master, herd, dt.date(2024, 5, 1),
                                                 dt.date(2024, 5, 31)).collect()}["6 tháng"]
    assert m["coverage"] == 30.0 and m["ok"] is True


def test_period_class_outlier_and_distinct(spark):
    herd = _herd(spark, [(6.0, 10)])
    rows = [(dt.date(2024, 5, 3), "1", "heifer", 6.0, 200.0, 0, None),
            (dt.date(2024, 5, 4), "1", "heifer", 6.1, 210.0, 0, None),     # same animal twice
            (dt.date(2024, 5, 4), "2", "heifer", 6.0, 99.0, 0, None),      # outlier
            (dt.date(2024, 5, 4), "3", "cow", 6.0, 200.0, 1, 10),          # wrong class
            (dt.date(2024, 5, 4), None, "heifer", 6.0, 200.0, 0, None),    # no herd number
            (dt.date(2024, 4, 30), "4", "heifer", 6.0, 200.0, 0, None),    # before the month
            (dt.date(2024, 5, 20), "5", "heifer", 6.0, 200.0, 0, None)]    # after report day
    master = spark.createDataFrame(rows, MASTER)
    r = {x["label"]: x for x in weekly_coverage(master, herd, dt.date(2024, 5, 10)).collect()}["6 tháng"]
    assert (r["weighed"], r["n_valid"], r["avg_weight"]) == (1, 2, 205.0)


def test_forward_snapshot_may_fall_in_later_month(spark):
    herd = _herd(spark, [(6.0, 3)], day=dt.date(2024, 4, 20)).unionByName(
        _herd(spark, [(6.0, 7)], day=dt.date(2024, 6, 2)))
    cov = weekly_coverage(spark.createDataFrame([], MASTER), herd, dt.date(2024, 5, 10))
    assert {x["label"]: x["baseline"] for x in cov.collect()}["6 tháng"] == 7


def test_monthly_groups_boundaries(spark):
    d = dt.date(2024, 5, 5)
    herd = spark.createDataFrame(
        [(dt.date(2024, 5, 1), 6.9, 0, None), (dt.date(2024, 5, 1), 6.0, 0, None),
         (dt.date(2024, 5, 1), None, 1, 30), (dt.date(2024, 5, 1), None, 3, 120)], HERD)
    master = spark.createDataFrame(
        [(d, "1", "heifer", 6.9, 200.0, 0, None),      # out of the monthly heifer band
         (d, "2", "cow", None, 400.0, 1, 30),          # calving out, peak in, all-lact peak in
         (d, "3", "cow", None, 500.0, 3, 120)],        # peak out, MBW in
        MASTER)
    g = {x["label"]: x for x in month_groups(master, herd, dt.date(2024, 5, 1), dt.date(2024, 5, 31)).collect()}
    assert len(g) == 7
    assert g["Heifer 6mo (5.5-6.9)"]["baseline"] == 1 and g["Heifer 6mo (5.5-6.9)"]["weighed"] == 0
    assert g["1st Calving"]["weighed"] == 0 and g["1st Calving"]["baseline"] == 0
    assert g["1st Peak"]["weighed"] == 1 and g["All Lact Peak"]["weighed"] == 1
    assert g["MBW"]["weighed"] == 1 and g["MBW"]["baseline"] == 1
    assert g["Heifer 12mo (11.5-12.9)"]["coverage"] == 0.0 and g["Heifer 12mo (11.5-12.9)"]["avg_w"] is None


def test_band_join_is_an_equi_join(spark):
    herd = _herd(spark, [(6.0, 3)])
    master = spark.createDataFrame([(dt.date(2024, 5, 3), "1", "heifer", 6.0, 200.0, 0, None)], MASTER)
    plan = weekly_coverage(master, herd, dt.date(2024, 5, 10))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def _pairs(df, bands, cond, spans):
    return sorted(band_join(df, bands, cond, spans).select("x", "b_id").collect(), key=str)


def test_thousands_of_overlapping_bands(spark):
    """Wide, narrow, point, endless and empty bands with both kinds of bounds, against plain Python."""
    rng = random.Random(9)
    inf = float("inf")
    bands = [(i, lo, lo + rng.choice([0.0, 1e-9, 0.3, 7.0, 500.0, 1e7])) for i, lo in enumerate(rng.uniform(-100, 100) for _ in range(3000))]
    bands += [(3001, -inf, inf), (3002, 5.0, inf), (3003, None, 5.0), (3004, 9.0, 3.0), (3005, 1e15, 2e15), (3006, 0.0, 0.0), (3007, -inf, -50.0)]
    values = [rng.uniform(-150, 600) for _ in range(150)] + [b[1] for b in bands[:40]] + [b[2] for b in bands[:40]]
    values += [None, float("nan"), inf, -inf, 0.0, -0.0, 1.5e15, 1e300, 5.0]
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "x int, v double")
    b = spark.createDataFrame(bands, "b_id int, b_lo double, b_hi double")
    spans = [Span("v", "b_lo", "b_hi")]
    for closed in (True, False):
        upper = F.col("v") <= F.col("b_hi") if closed else F.col("v") < F.col("b_hi")
        want = [(x, i) for x, v in rows if v is not None and v == v for i, lo, hi in bands
                if lo is not None and lo <= v and (v <= hi if closed else v < hi)]
        assert [tuple(r) for r in _pairs(df, b, (F.col("v") >= F.col("b_lo")) & upper, spans)] == sorted(want, key=str)
    plan = band_join(df, b, F.col("v") >= F.col("b_lo"), spans)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert _pairs(df, b.limit(0), F.col("v") >= F.col("b_lo"), spans) == []


def test_bands_of_different_spans(spark):
    bands = spark.createDataFrame([(1, "a", 0, 10, None, None), (2, "b", None, None, 5, 6), (3, None, None, None, 0, 100)],
                                  "b_id int, b_type string, b_lo int, b_hi int, b_from int, b_to int")
    df = spark.createDataFrame([(1, 3, 5), (2, 30, 50), (3, None, 5), (4, 3, None)], "x int, v int, w int")
    cond = F.when(F.col("b_type") == "a", F.col("v").between(F.col("b_lo"), F.col("b_hi"))).otherwise(F.col("w").between(F.col("b_from"), F.col("b_to")))
    spans = [Span("v", "b_lo", "b_hi", "b_type = 'a'"), Span("w", "b_from", "b_to", "NOT (b_type <=> 'a')")]
    assert [tuple(r) for r in _pairs(df, bands, cond, spans)] == [(1, 1), (1, 2), (1, 3), (2, 3), (3, 2), (3, 3), (4, 1)]


def test_totals_of_bands_without_their_pairs(spark):
    """The same bands and values as totals, against plain Python; the rows that any join makes grow with rows and bands only."""
    rng = random.Random(10)
    inf, nan = float("inf"), float("nan")
    bands = [(i, lo, lo + rng.choice([0.0, 1e-9, 0.3, 7.0, 500.0, 1e7])) for i, lo in enumerate(rng.uniform(-100, 100) for _ in range(900))]
    bands += [(901, -inf, inf), (902, 5.0, inf), (903, None, 5.0), (904, 9.0, 3.0), (905, 1e15, 2e15), (906, 0.0, 0.0), (907, -inf, -50.0)]
    bands += [(908, 0.0, nan), (None, 1.0, 2.0), (7, 1.0, 2.0), (7, 1.0, 2.0), (909, -0.0, 0.0)]
    values = [rng.uniform(-150, 600) for _ in range(150)] + [b[1] for b in bands[:40]] + [b[2] for b in bands[:40]] + [1.0, 1.0, 2.0, 2.0, 1.5]
    values += [None, nan, inf, -inf, 0.0, -0.0, 1.5e15, 1e300, 5.0]
    rows = [(None if i % 7 == 0 else i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "x int, v double")
    b = spark.createDataFrame(bands, "b_id int, b_lo double, b_hi double")
    totals = {"n": ("count", None), "top": ("max", "x"), "least": ("min", "x"), "whole": ("sum", "x")}
    below = lambda v, hi, closed: hi != hi or (v <= hi if closed else v < hi)
    for low_in, high_in in ((True, True), (True, False), (False, True), (False, False)):
        want = []
        for i, lo, hi in bands:
            met = [x for x, v in rows if lo is not None and v is not None and v == v and (lo <= v if low_in else lo < v) and below(v, hi, high_in)]
            some = [x for x in met if x is not None]
            if met and (hi != hi or lo <= hi):
                want.append((i, len(met), max(some, default=None), min(some, default=None), sum(some) if some else None))
        got = band_join(df, b, None, [Span("v", "b_lo", "b_hi", low_in=low_in, high_in=high_in)], totals)
        assert sorted(map(tuple, got.select("b_id", *totals).collect()), key=str) == sorted(want, key=str)
    spans = [Span("v", "b_lo", "b_hi")]
    assert band_join(df, b.limit(0), None, spans, totals).collect() == []
    assert band_join(df.limit(0), b, None, spans, totals).collect() == []


def test_every_row_in_every_band_makes_no_pairs(spark):
    """20,000 bands around 20,000 rows have 400,000,000 pairs."""
    df = spark.range(20_000).select("id", F.col("id").cast("double").alias("v"))
    b = spark.range(20_000).select(F.col("id").alias("b_id"), (-F.col("id") - 1).cast("double").alias("b_lo"), (F.col("id") + 20_000).cast("double").alias("b_hi"))
    got = band_join(df, b, None, [Span("v", "b_lo", "b_hi")], {"n": ("count", None), "top": ("max", "id")})
    assert got.agg(F.count("*"), F.min("n"), F.max("n"), F.min("top")).first() == (20_000, 20_000, 20_000, 19_999)
