"""Conform to the master schema."""
import datetime as dt
import math

from pyspark.sql import types as T

from herdflow.operators.conform import conform
from herdflow.schemas import MASTER_COLUMNS

SCHEMA = ("source string, device string, date string, time string, no string, ear_tag string, "
          "group_name string, animal_type string, weight double, age_month double, age_days int, "
          "dim int, lac_no int, operation_tag string, stt string")
ROW = ("PTM", "SCALE9", "2022-09-10", "18:42", "88", "370550012", "Dry", "cow", 611.5, 46.0, 1400, 56, 3, "EVE", "7")


def _conf(spark, rows, schema=SCHEMA):
    return conform(spark.createDataFrame(rows, schema), "2022-09-11 04:30:00")


def test_rename_order_and_extras(spark):
    out = _conf(spark, [ROW])
    assert out.columns == MASTER_COLUMNS
    assert "operation_tag" not in out.columns and "stt" not in out.columns
    r = out.first()
    assert r["weight_kg"] == 611.5 and r["loaded_at"] == dt.datetime(2022, 9, 11, 4, 30)


def test_types(spark):
    f = {x.name: x.dataType for x in _conf(spark, [ROW]).schema.fields}
    assert f["weight_kg"] == T.DoubleType() and f["age_days"] == T.ShortType()
    assert f["lac_no"] == T.ByteType() and f["date"] == T.DateType()


def test_null_tokens_and_trim(spark):
    row = list(ROW)
    row[4], row[6], row[7] = " nan ", "None", "  cow  "
    r = _conf(spark, [tuple(row)]).first()
    assert r["no"] is None and r["group_name"] is None and r["animal_type"] == "cow"


def test_conform_tokens_are_exact(spark):
    row = list(ROW)
    row[4] = "NULL"                     # not a conform token (the repair vocabulary has it)
    assert _conf(spark, [tuple(row)]).first()["no"] == "NULL"


def test_negative_ages_nulled(spark):
    row = list(ROW)
    row[9], row[10], row[11] = -0.5, -3, -1
    r = _conf(spark, [tuple(row)]).first()
    assert r["age_month"] is None and r["age_days"] is None and r["dim"] is None


def test_nan_weight_is_null(spark):
    row = list(ROW)
    row[8] = math.nan
    assert _conf(spark, [tuple(row)]).first()["weight_kg"] is None


def test_fraction_and_overflow_rejected_not_truncated(spark):
    schema = SCHEMA.replace("age_days int", "age_days double").replace("lac_no int", "lac_no double")
    row = list(ROW)
    row[10], row[12] = 12.5, 300.0
    r = _conf(spark, [tuple(row)], schema).first()
    assert r["age_days"] is None and r["lac_no"] is None


def test_missing_columns_are_typed_nulls(spark):
    df = spark.createDataFrame([("PTM", 1.0)], "source string, weight double")
    out = conform(df, "2024-06-01 00:00:00")
    assert out.columns == MASTER_COLUMNS and out.first()["no"] is None
    assert conform(df, "2024-06-01 00:00:00", add_missing=False).columns == ["source", "weight_kg", "loaded_at"]


def test_bad_date_string_kept_as_null(spark):
    row = list(ROW)
    row[2] = "2024-02-30"
    out = _conf(spark, [tuple(row)])
    assert out.count() == 1 and out.first()["date"] is None


def test_loaded_at_is_one_literal(spark):
    out = _conf(spark, [ROW, ROW])
    assert out.select("loaded_at").distinct().count() == 1
