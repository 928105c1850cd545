"""Schemas, keys, band tables and thresholds.

FIXED VALUES — these must equal the values the weigh reports are defined with
(master column order, dedup key, band tables, thresholds); they are stated here
as plain data in their natural order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------- FIXED VALUES
MASTER_COLUMNS = [
    "source", "device",
    "date", "time",
    "no", "ear_tag",
    "group_name", "animal_type",
    "weight_kg",
    "age_month", "age_days",
    "dim", "lac_no",
    "loaded_at",
]
DEDUP_KEYS = ["date", "ear_tag", "device"]
MASTER_ORDER = ["date", "device", "ear_tag"]

WEIGHT_LOW, WEIGHT_HIGH = 60.0, 900.0          # master range filter and A8 mean
MONTH_OUTLIER_LOW, MONTH_OUTLIER_HIGH = 100.0, 800.0
MONTHLY_THRESHOLD = 30.0
NO_DATA_ALERT_DAYS = 7
RETENTION_THRESHOLD, RETENTION_BUFFER = 8000, 2000
JOIN_RATE_MIN, JOIN_RATE_MIN_ROWS = 0.3, 20
AGE_MONTH_DAYS = 30.44
REFETCH_DAYS_BACK, REFETCH_DAYS_FORWARD = 7, 1

# week of month -> minimum coverage %, week 3 and later use the last value
WEEK_THRESHOLDS = {1: 10.0, 2: 20.0, 3: 30.0}

# Weekly age bands: all bounds inclusive.
# (label, baseline_min, baseline_max, weight_min, weight_max, outlier_low, outlier_high)
AGE_GROUPS = [
    ("6 tháng", 5.3, 6.7, 5.5, 6.9, 100, 350),
    ("9 tháng", 8.3, 9.7, 8.5, 9.9, 250, 500),
    ("12 tháng", 11.3, 12.7, 11.5, 12.9, 300, 600),
]

# Monthly groups: age and dim upper-exclusive, lac_no inclusive.
# (label, type, age_min, age_max, lac_min, lac_max, dim_min, dim_max, w_low, w_high)
MONTHLY_COW_GROUPS = [
    ("Heifer 6mo (5.5-6.9)", "heifer", 5.5, 6.9, None, None, None, None, 100, 350),
    ("Heifer 9mo (8.5-9.9)", "heifer", 8.5, 9.9, None, None, None, None, 250, 500),
    ("Heifer 12mo (11.5-12.9)", "heifer", 11.5, 12.9, None, None, None, None, 300, 600),
    ("1st Calving", "cow", None, None, 1, 1, 0, 30, 300, 700),
    ("1st Peak", "cow", None, None, 1, 1, 30, 120, 300, 700),
    ("All Lact Peak", "cow", None, None, 1, 20, 30, 120, 300, 700),
    ("MBW", "cow", None, None, 3, 4, 120, 180, 400, 900),
]

# Device defaults by source for the device repair. The source map in the original
# has "PTM" twice; the later entry wins, so PTM defaults to CIMA2.
SOURCE_DEVICE_DEFAULT = {"PTM": "CIMA2", "GALLAGHER": "GALLAGHER_1"}

# Null vocabularies: conform = exact tokens after strip; repair = case-insensitive.
CONFORM_NULL_TOKENS = ["nan", "None", "NaT", ""]
REPAIR_NULL_TOKENS = ["nan", "none", "null", "nat", "<na>", "n/a", ""]
INVALID_TAG_TOKENS = ["", "nan", "none", "nat", "null"]
UNKNOWN_NO_TOKENS = ["", "nan", "none"]
BLOB_HEADER_KEYWORDS = ["DATE", "TOTAL SUM", "AVERAGE WEIGHT"]
LEGACY_CLASSES = ["milking_cow", "dry", "other"]
LEGACY_RENAMES = {"cow_id": "no", "age_months": "age_month",
                  "lactation_no": "lac_no"}
LEGACY_DROPS = ["operationTag", "raw_line", "STT"]
# ------------------------------------------------------------ END FIXED VALUES

STRING_COLUMNS = ["source", "device", "no", "ear_tag", "group_name", "animal_type"]

MASTER_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("time", T.StringType()),
    T.StructField("no", T.StringType()),
    T.StructField("ear_tag", T.StringType()),
    T.StructField("group_name", T.StringType()),
    T.StructField("animal_type", T.StringType()),
    T.StructField("weight_kg", T.DoubleType()),
    T.StructField("age_month", T.DoubleType()),
    T.StructField("age_days", T.ShortType()),
    T.StructField("dim", T.ShortType()),
    T.StructField("lac_no", T.ByteType()),
    T.StructField("loaded_at", T.TimestampType()),
])

PARSED_BLOB_SCHEMA = T.StructType([
    T.StructField("operation_tag", T.StringType()),
    T.StructField("stt", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("ear_tag", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("time", T.StringType()),
])

SESSION_ANIMAL = T.StructType([
    T.StructField("rfid", T.StringType()),
    T.StructField("currentWeight", T.DoubleType()),
    T.StructField("scanDate", T.StringType()),
])
SESSION_DOC_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("animals", T.StructType([
        T.StructField("values", T.ArrayType(SESSION_ANIMAL)),
    ])),
])
SESSION_LISTING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("createdAt", T.StringType()),
    T.StructField("animalCount", T.LongType()),
])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("date_time", T.TimestampType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("msg", T.StringType()),
])

WEEKLY_BAND_SCHEMA = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("baseline_min", T.DoubleType()),
    T.StructField("baseline_max", T.DoubleType()),
    T.StructField("weight_min", T.DoubleType()),
    T.StructField("weight_max", T.DoubleType()),
    T.StructField("outlier_low", T.DoubleType()),
    T.StructField("outlier_high", T.DoubleType()),
])

MONTHLY_BAND_SCHEMA = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("type", T.StringType()),
    T.StructField("age_min", T.DoubleType()),
    T.StructField("age_max", T.DoubleType()),
    T.StructField("lac_min", T.IntegerType()),
    T.StructField("lac_max", T.IntegerType()),
    T.StructField("dim_min", T.IntegerType()),
    T.StructField("dim_max", T.IntegerType()),
    T.StructField("w_low", T.DoubleType()),
    T.StructField("w_high", T.DoubleType()),
])


def _sql_literal(v, type_: str) -> str:
    if v is None:
        return f"CAST(NULL AS {type_})"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v!r} AS {type_})"


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small fixed table as an inline VALUES relation: it lives in the plan (no Python
    RDD), carries exact size statistics and is therefore broadcast without a shuffle."""
    cols = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v, t) for v, (_, t) in zip(r, cols)) + ")"
                       for r in rows)
    names = ", ".join(f"`{n}`" for n, _ in cols)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def weekly_bands(spark: SparkSession) -> DataFrame:
    """Weekly band table with its display order (`ord`)."""
    rows = [(i, lbl, float(a), float(b), float(c), float(d), float(e), float(f))
            for i, (lbl, a, b, c, d, e, f) in enumerate(AGE_GROUPS)]
    schema = T.StructType([T.StructField("ord", T.IntegerType(), False)] + WEEKLY_BAND_SCHEMA.fields)
    return local_table(spark, rows, schema)


def monthly_bands(spark: SparkSession) -> DataFrame:
    rows = []
    for i, (lbl, typ, amin, amax, lmin, lmax, dmin, dmax, wl, wh) in enumerate(MONTHLY_COW_GROUPS):
        rows.append((i, lbl, typ,
                     None if amin is None else float(amin), None if amax is None else float(amax),
                     lmin, lmax, dmin, dmax, float(wl), float(wh)))
    schema = T.StructType([T.StructField("ord", T.IntegerType(), False)] + MONTHLY_BAND_SCHEMA.fields)
    return local_table(spark, rows, schema)
