"""Tag cleaning and identifier normalisation."""
from herdflow.functions.text import clean_tag, normalize_id
from herdflow.operators.conform import drop_invalid_tags


def _clean(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(clean_tag("t")).collect()]


def _norm(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(normalize_id("t")).collect()]


def test_leading_zeros(spark):
    assert _clean(spark, ["000370550"]) == ["370550"]


def test_dot_zero(spark):
    assert _clean(spark, ["81200.0", "5.00"]) == ["81200", "5.00"]


def test_whitespace_and_tabs(spark):
    assert _clean(spark, [" 77 ", "\t78\n", "\u00a079\u00a0"]) == ["77", "78", "79"]


def test_long_tag_unchanged(spark):
    assert _clean(spark, ["415000000123456"]) == ["415000000123456"]


def test_zero_becomes_empty(spark):
    assert _clean(spark, ["0", "000"]) == ["", ""]


def test_invalid_rows_dropped(spark):
    df = spark.createDataFrame([(v, 1.0) for v in ["", "nan", "none", "NaN", "NULL", "nat", "0", "123"]] +
                               [(None, 1.0)], "ear_tag string, weight double")
    out = [r[0] for r in drop_invalid_tags(df).collect()]
    assert out == ["123"]


def test_normalize_forms_of_one_id(spark):
    assert _norm(spark, ["0415000000123", "415000000124.0", "4.15000000123e+11"]) == \
        ["415000000123", "415000000124", "415000000123"]


def test_normalize_needs_decimal_point_and_keeps_null(spark):
    assert _norm(spark, ["9e+14", None, " 0012 "]) == ["9e+14", None, "12"]


def test_normalize_scientific_truncates(spark):
    assert _norm(spark, ["1.5e+00"]) == ["1"]
