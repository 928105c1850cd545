"""Calendar, name and id scalars."""
import datetime as dt

from pyspark.sql import functions as F

from herdflow.functions.dates import (age_month, coverage_threshold, day_diff, fmt_date, fmt_pct,
                                      is_month_end, month_end, month_start, week_of_month, year_month)
from herdflow.functions.text import safe_name, session_id, source_of


def _one(spark, value, schema, expr):
    return spark.createDataFrame([(value,)], schema).select(expr).first()[0]


def test_calendar(spark):
    d = dt.date(2024, 2, 29)
    row = spark.createDataFrame([(d,)], "d date").select(
        year_month("d"), month_start("d"), month_end("d"), is_month_end("d"), week_of_month("d"),
        fmt_date("d"), fmt_date("d", "MM/yyyy")).first()
    assert tuple(row) == ("2024-02", dt.date(2024, 2, 1), dt.date(2024, 2, 29), True, 5, "29/02/2024", "02/2024")


def test_week_thresholds(spark):
    days = [1, 7, 8, 14, 15, 22, 31]
    df = spark.createDataFrame([(dt.date(2024, 5, x),) for x in days], "d date")
    got = [(r[0], r[1]) for r in df.select(week_of_month("d").alias("w"),
                                           coverage_threshold(week_of_month("d"))).collect()]
    assert got == [(1, 10.0), (1, 10.0), (2, 20.0), (2, 20.0), (3, 30.0), (4, 30.0), (5, 30.0)]


def test_day_diff_age_month_and_pct(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 3), dt.date(2024, 5, 1), 730, 29.96)],
                               "s date, d date, a int, p double")
    r = df.select(day_diff("s", "d"), age_month("a"), fmt_pct("p")).first()
    assert tuple(r) == (2, 24.0, "30.0%")
    assert _one(spark, None, "d date", day_diff(F.lit(dt.date(2024, 1, 1)), F.col("d"))) is None


def test_safe_name_and_source(spark):
    name = ' op 1: a/b\\c*?"<>| '
    assert _one(spark, name, "s string", safe_name("s")) == " op 1_ a_b_c______ "
    assert _one(spark, name, "s string", safe_name("s", strict=True)) == "op_1__a_b_c"
    assert _one(spark, "gallagher_1", "s string", source_of("s")) == "GALLAGHER"
    assert _one(spark, "CIMA2", "s string", source_of("s")) == "PTM"


def test_session_id(spark):
    df = spark.createDataFrame([("/api/sessions/123",), ("/api/sessions/12x",), ("",), (None,),
                                ("/api/sessions/",)], "h string")
    assert [r[0] for r in df.select(session_id("h")).collect()] == [123, None, None, None, None]
