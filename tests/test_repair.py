"""Repairs of an existing master."""
import datetime as dt

from herdflow.operators.repair import (fill_device, migrate_legacy, repair_class, repair_device,
                                       repair_null_counts, repair_nulls, round_age_month)

D = dt.date(2024, 1, 5)
SCHEMA = ("source string, device string, date date, ear_tag string, time string, weight_kg double, "
          "loaded_at timestamp")


def test_fill_device_cases(spark):
    t = dt.datetime(2024, 2, 1)
    df = spark.createDataFrame([
        ("PTM", "CIMA2", D, "1", "07:00", 1.0, t), ("PTM", "CIMA1", D, "1", "07:10", 1.0, t),
        ("PTM", None, D, "1", "08:00", 2.0, t),           # match -> first in master order = CIMA1
        ("PTM", None, D, "9", "08:00", 3.0, t),           # no match, PTM -> CIMA2
        ("GALLAGHER", None, D, "8", "08:00", 3.0, t),     # no match -> GALLAGHER_1
        ("OTHER", None, D, "7", "08:00", 3.0, t),         # unknown source -> UNKNOWN
        ("PTM", "CIMA1", D, None, "09:00", 4.0, t),       # null tag on both sides match
        ("PTM", None, D, None, "09:30", 5.0, t),
    ], SCHEMA)
    got = {(r["ear_tag"], r["time"]): r["device"] for r in fill_device(df).collect()}
    assert got[("1", "08:00")] == "CIMA1" and got[("9", "08:00")] == "CIMA2"
    assert got[("8", "08:00")] == "GALLAGHER_1" and got[("7", "08:00")] == "UNKNOWN"
    assert got[(None, "09:30")] == "CIMA1" and got[("1", "07:00")] == "CIMA2"


def test_repair_device_rededuplicates(spark):
    df = spark.createDataFrame([
        ("PTM", "CIMA1", D, "1", "07:00", 1.0, dt.datetime(2024, 2, 1)),
        ("PTM", None, D, "1", "08:00", 2.0, dt.datetime(2024, 2, 2)),
    ], SCHEMA)
    out = repair_device(df).collect()
    assert len(out) == 1 and out[0]["weight_kg"] == 2.0


def test_repair_nulls_and_counts(spark):
    df = spark.createDataFrame([("nan", " N/A ", "<NA>", "x", -1, -0.5), ("a", "b", "c", "d", 5, 1.0)],
                               "no string, group_name string, device string, source string, "
                               "age_days int, age_month double")
    r = repair_nulls(df).collect()
    assert (r[0]["no"], r[0]["group_name"], r[0]["device"], r[0]["age_days"], r[0]["age_month"]) == \
        (None, None, None, None, None)
    assert (r[1]["no"], r[1]["age_days"]) == ("a", 5)
    c = repair_null_counts(df).first()
    assert (c["n_str_null"], c["n_negative"]) == (3, 2)


def test_repair_class_only_when_legacy_present(spark):
    df = spark.createDataFrame([("1", 2, "heifer"), ("2", 0, "cow")], "no string, lac_no int, animal_type string")
    assert [r[0] for r in repair_class(df).select("animal_type").collect()] == ["heifer", "cow"]
    df2 = df.unionByName(spark.createDataFrame([(None, 1, "milking_cow")], df.schema))
    assert [r[0] for r in repair_class(df2).select("animal_type").collect()] == ["cow", "heifer", "unknown"]


def test_migrate_legacy(spark):
    df = spark.createDataFrame([(" 0012.0 ", "0064.0", "CIMA1", "512.5", "6.25", "190", "1.0", "x", "r", "keep")],
                               "` cow_id ` string, ear_tag string, device string, weight_kg string, "
                               "age_months string, age_days string, lactation_no string, STT string, "
                               "raw_line string, note string")
    out = migrate_legacy(df, "2024-01-01 00:00:00")
    assert out.columns == ["source", "device", "no", "ear_tag", "animal_type", "weight_kg", "age_month",
                           "age_days", "dim", "lac_no", "loaded_at", "note"]
    r = out.first()
    assert (r["source"], r["no"], r["ear_tag"], r["animal_type"]) == ("PTM", "12", "64", "cow")
    assert (r["weight_kg"], r["age_month"], r["age_days"], r["lac_no"]) == (512.5, 6.2, 190, 1)


def test_round_age_month(spark):
    df = spark.createDataFrame([(6.25,), (6.35,)], "age_month double")
    assert [r[0] for r in round_age_month(df).collect()] == [6.2, 6.4]
