"""Report aggregates."""
import datetime as dt

from herdflow.operators.aggregates import (curve, day_counts, freshness, histogram, month_headline,
                                           monthly_by_key, top_groups, value_counts)

M = ("date date, device string, ear_tag string, no string, weight_kg double, age_month double, "
     "age_days smallint, dim smallint, lac_no tinyint, group_name string, animal_type string")


def test_monthly_by_key_outliers_and_last_non_null(spark):
    d1, d2, d3 = dt.date(2024, 1, 3), dt.date(2024, 1, 9), dt.date(2024, 2, 1)
    df = spark.createDataFrame([
        (d1, "A", "t", "1", 59.9, 5.04, 153, None, 0, "G1", "heifer"),
        (d1, "B", "t", "1", 60.0, 5.1, 155, None, 0, "G2", "heifer"),
        (d2, "A", "t", "1", 900.0, 5.3, 161, None, 0, None, "heifer"),
        (d2, "B", "t", "1", 900.1, 5.2, 158, None, 0, None, None),
        (d3, "A", "t", "1", 50.0, 6.0, 180, None, 0, "G3", "heifer"),   # month with only outliers
        (d1, "A", "u", None, 300.0, 1.0, 30, None, 0, "G9", "unknown"),  # no herd number: dropped
    ], M)
    got = {r["year_month"]: r for r in monthly_by_key(df).collect()}
    assert set(got) == {"2024-01", "2024-02"}
    jan = got["2024-01"]
    assert jan["weight_kg"] == 480.0 and jan["age_month"] == 5.3 and jan["age_days"] == 161
    assert jan["group_name"] == "G2" and jan["animal_type"] == "heifer"
    assert got["2024-02"]["weight_kg"] is None


def test_day_counts_and_top_groups(spark):
    d = dt.date(2024, 1, 3)
    rows = [(d, "A", str(i), "1", 1.0, 1.0, 1, 1, 1 if i % 2 else None, f"G{i % 9}", "cow" if i % 3 else "heifer")
            for i in range(40)] + [(d, "A", "x", None, 1.0, 1.0, 1, 1, 1, None, "unknown")]
    df = spark.createDataFrame(rows, M)
    c = day_counts(df).first()
    assert (c["n_cow"], c["n_heifer"], c["n_unknown"], c["n_total"]) == (26, 14, 1, 41)
    top = [(r["group_name"], r["n"]) for r in top_groups(df, k=3).collect()]
    assert top == [("G1", 3), ("G3", 3), ("G0", 2)]      # ties broken by name
    plan = top_groups(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_curves(spark):
    d = dt.date(2024, 1, 3)
    df = spark.createDataFrame([(d, "A", "1", "1", 100.0, 6.5, 1, 10, 0, "g", "heifer"),
                                (d, "A", "2", "1", 200.0, 7.5, 1, 10, 0, "g", "heifer"),
                                (d, "A", "3", "1", 300.0, None, 1, None, 0, "g", "heifer")], M)
    got = {r["age_month_r"]: r["avg_weight_kg"] for r in curve(df, "age_month", round_digits=0).collect()}
    assert got == {6.0: 100.0, 8.0: 200.0}      # half-even: 6.5 -> 6, 7.5 -> 8
    assert {r["dim"]: r["n"] for r in curve(df, "dim").collect()} == {10: 2}


def test_histogram_last_bin_closed_and_single_value(spark):
    df = spark.createDataFrame([("a", float(x)) for x in range(0, 21)] + [("b", 5.0), ("b", 5.0)],
                               "k string, x double")
    h = {(r["k"], r["bin"]): r["n"] for r in histogram(df, "x", 20, by="k").collect()}
    assert h[("a", 19)] == 2 and h[("a", 0)] == 1 and sum(v for (k, _), v in h.items() if k == "a") == 21
    assert h[("b", 10)] == 2 and sum(1 for (k, _) in h if k == "b") == 20
    plan = histogram(df, "x", 20)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_freshness_and_headline(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3), "A", "1", "1", 99.0, 1.0, 1, 1, 1, "g", "cow"),
                                (dt.date(2024, 1, 9), "A", "1", None, 500.0, 1.0, 1, 1, 1, "g", "cow"),
                                (dt.date(2024, 1, 9), "A", "2", "3", None, 1.0, 1, 1, 1, "g", "cow")], M)
    f = freshness(df, dt.date(2024, 1, 20)).first()
    assert (f["last_date"], f["gap_days"], f["alert"]) == (dt.date(2024, 1, 9), 11, True)
    assert freshness(df, dt.date(2024, 1, 12)).first()["alert"] is False
    h = month_headline(df).first()
    assert (h["n_rows"], h["n_with_no"], h["n_outliers"]) == (3, 2, 2)


def test_value_counts_keep_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r["k"]: r["n"] for r in value_counts(df, "k").collect()} == {"a": 2, None: 1}
    assert {r["k"]: r["n"] for r in value_counts(df, "k", dropna=True).collect()} == {"a": 2}
