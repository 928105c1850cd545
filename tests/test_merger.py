"""Herd enrichment and back-dating."""
import datetime as dt

import pytest

from herdflow.operators.enrich import enrich, match_counts


@pytest.fixture()
def weights(spark):
    return spark.createDataFrame(
        [("T-7", 611.5, dt.date(2022, 9, 10)), ("T-19", 190.0, dt.date(2022, 9, 10)),
         ("T-404", 333.0, dt.date(2022, 9, 10))], "ear_tag string, weight double, date date")


@pytest.fixture()
def herd(spark):
    return spark.createDataFrame(
        [(dt.date(2022, 9, 15), "88", "T-7", "Dry", 1405, 61, 3),
         (dt.date(2022, 9, 15), "89", "T-19", "Calf", 95, None, None)],
        "date date, no string, transp_2 string, group_name string, age_days int, dim int, lac_no int")


def test_match_counts(spark, weights, herd):
    m = match_counts(enrich(weights, herd)).first()
    assert (m["total"], m["matched"], m["unmatched"]) == (3, 2, 1)


def test_backdating_by_five_days(spark, weights, herd):
    r = {x["ear_tag"]: x for x in enrich(weights, herd).collect()}
    assert r["T-7"]["age_days"] == 1400 and r["T-7"]["dim"] == 56
    assert r["T-7"]["age_month"] == round(1400 / 30.44, 1)
    assert r["T-19"]["age_days"] == 90 and r["T-19"]["dim"] is None


def test_unmatched_row_has_null_herd(spark, weights, herd):
    r = {x["ear_tag"]: x for x in enrich(weights, herd).collect()}
    assert r["T-404"]["no"] is None and r["T-404"]["age_month"] is None


def test_right_key_dropped(spark, weights, herd):
    assert "transp_2" not in enrich(weights, herd).columns


def test_no_herd_gives_null_columns(spark, weights):
    out = enrich(weights, None)
    assert {"no", "group_name", "age_days", "age_month", "dim", "lac_no"} <= set(out.columns)
    assert out.where("no is not null").count() == 0


def test_keys_normalised_on_both_sides(spark):
    w = spark.createDataFrame([("00415000000123", dt.date(2024, 5, 1))], "ear_tag string, date date")
    h = spark.createDataFrame([(dt.date(2024, 5, 1), "7", "4.15000000123e+11", 10)],
                              "date date, no string, transp_2 string, age_days int")
    r = enrich(w, h).first()
    assert r["no"] == "7" and r["ear_tag"] == "415000000123"


def test_matched_tag_with_null_no_is_not_adjusted(spark):
    """A herd row whose number is null counts as unmatched and keeps its age."""
    w = spark.createDataFrame([("5", dt.date(2024, 5, 1))], "ear_tag string, date date")
    h = spark.createDataFrame([(dt.date(2024, 5, 11), None, "5", 100)],
                              "date date, no string, transp_2 string, age_days int")
    r = enrich(w, h).first()
    assert r["age_days"] == 100 and r["age_month"] == round(100 / 30.44, 1)
    assert match_counts(enrich(w, h)).first()["matched"] == 0


def test_duplicate_herd_rows_fan_out(spark, weights, herd):
    assert enrich(weights, herd.unionByName(herd)).count() == 5


def test_empty_input_gives_null_rate(spark, herd):
    w = spark.createDataFrame([], "ear_tag string, weight double, date date")
    m = match_counts(enrich(w, herd)).first()
    assert m["total"] == 0 and m["matched_pct"] is None
