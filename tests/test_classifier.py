"""Animal class truth table."""
import math

import pytest

from herdflow.functions.classify import add_animal_type, classify

NO_UNKNOWN = [None, "nan", "NaN", "none", "None", "", "   "]
LAC_COW = ["1", "2", "1.0", " 2 ", "3.5"]
LAC_HEIFER = ["0", "0.0", "-1", "0.9", None, "abc", "", "nan"]


def _cls(spark, pairs, schema="no string, lac_no string"):
    df = spark.createDataFrame(pairs, schema)
    return [r[0] for r in df.select(classify("no", "lac_no")).collect()]


@pytest.mark.parametrize("no", NO_UNKNOWN)
def test_unknown_when_no_missing(spark, no):
    assert _cls(spark, [(no, "2")]) == ["unknown"]


@pytest.mark.parametrize("lac", LAC_COW)
def test_cow(spark, lac):
    assert _cls(spark, [("1234", lac)]) == ["cow"]


@pytest.mark.parametrize("lac", LAC_HEIFER)
def test_heifer(spark, lac):
    assert _cls(spark, [("1234", lac)]) == ["heifer"]


def test_numeric_columns_and_nan(spark):
    df = spark.createDataFrame([("1234", 1.0), ("1234", 0.0), ("1234", math.nan), ("1234", None)],
                               "no string, lac_no double")
    assert [r[0] for r in df.select(classify("no", "lac_no")).collect()] == ["cow", "heifer", "heifer", "heifer"]


def test_nan_no_numeric(spark):
    df = spark.createDataFrame([(math.nan, 2)], "no double, lac_no int")
    assert df.select(classify("no", "lac_no")).first()[0] == "unknown"


def test_missing_column_gives_unknown(spark):
    df = spark.createDataFrame([("1", "2")], "no string, other string")
    assert add_animal_type(df).first()["animal_type"] == "unknown"
    df2 = spark.createDataFrame([("1", "2")], "x string, lac_no string")
    assert add_animal_type(df2).first()["animal_type"] == "unknown"


def test_custom_column_names(spark):
    df = spark.createDataFrame([("7", "3")], "cow_no string, lactation string")
    assert add_animal_type(df, "cow_no", "lactation", "cls").first()["cls"] == "cow"


def test_input_not_modified(spark):
    df = spark.createDataFrame([("1", "2")], "no string, lac_no string")
    add_animal_type(df)
    assert df.columns == ["no", "lac_no"]
