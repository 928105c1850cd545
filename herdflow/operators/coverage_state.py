"""Exact distinct counts that merge: per (day, band) bitmaps of numbered animals.

Every animal gets a number once (`number_animals`). A day's state holds, per band, the bitmaps of the numbers
weighed on that day inside the band (32,768 numbers a bitmap) with the number of rows and the sum of weights.
States of any days merge by OR and by sums, so a report reads states instead of the master, and a late batch
costs the states of the days it touches. The counts are exact, as of the rows themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.operators.bands import (Span, band_join, month_bands, month_cond, month_groups_result, month_spans, week_bands,
                                      week_cond, week_result, week_spans)
from herdflow.operators.windows import running_total
from herdflow.session import path_exists
from herdflow.sinks.master import has_data, refresh_partitions

DAY = "day"
#: What the states of either report are of: bands, condition, spans and the rows that count.
WEEKLY, MONTHLY = "weekly", "monthly"


def number_animals(spark: SparkSession, path: str, rows: DataFrame, no_col: str = "no") -> DataFrame:
    """(no, num) of all animals known, after giving those of `rows` that have none the next numbers.

    Numbers run on from the largest without gaps, so bitmaps are dense; a number is never given twice
    or changed. The table is appended to; one run writes at a time.
    """
    schema = "no string, num bigint"
    known = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    names = rows.select(F.col(no_col).alias("no")).where("no IS NOT NULL").distinct()
    new = names.join(known, "no", "left_anti").withColumn("one", F.lit(1))
    last = known.agg(F.coalesce(F.max("num"), F.lit(-1)).alias("n")).first()["n"]
    numbered = running_total(new, ["no"], "one").select("no", (F.col("before") + F.lit(last + 1)).cast("bigint").alias("num"))
    numbered.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def day_states(rows: DataFrame, numbers: DataFrame, bands: DataFrame, cond: Column, spans: list[Span], date_col: str = "date",
               no_col: str = "no", weight_col: str = "weight_kg") -> DataFrame:
    """(day, b_label, bucket, bits, n, weight_sum) of rows with an animal; a row counts in each band that holds it."""
    met = band_join(rows.where(F.col(no_col).isNotNull()), bands, cond, spans)
    keyed = met.join(numbers.withColumnRenamed("no", "_no"), F.col(no_col) == F.col("_no"))
    day = F.date_format(F.col(date_col).cast("date"), "yyyy-MM-dd")
    return (keyed.groupBy(day.alias(DAY), "b_label", F.bitmap_bucket_number("num").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("num")).alias("bits"), F.count(F.lit(1)).alias("n"),
                 F.sum(weight_col).alias("weight_sum")))


def merged_stats(states: DataFrame, bands: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Per band the animals weighed, mean weight (unrounded) and rows of the days from `start` to `end`; empty bands -> 0 / null."""
    days = states.where(F.col(DAY).between(str(start), str(end)))
    bits = days.groupBy("b_label", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"),
                                                 F.sum("weight_sum").alias("w"))
    stats = bits.groupBy("b_label").agg(F.sum(F.bitmap_count("bits")).alias("weighed"), F.sum("n").alias("n_valid"), F.sum("w").alias("w"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return (bands.select("b_ord", "b_label").join(stats, "b_label", "left")
            .select("b_ord", "b_label", zero("weighed"), (F.col("w") / F.col("n_valid")).alias("avg_raw"), zero("n_valid")))


def refresh_states(spark: SparkSession, master: DataFrame, path: str, numbers: DataFrame, days: list[str | None], report: str = WEEKLY) -> None:
    """Recompute the states of the days given (as an upsert touched them) from the master and replace them; other days stay as they are.

    `master` has the day as a partition column, so only those days are read. Rows without a date are of no period.
    """
    known = [d for d in days if d is not None]
    rows = master.where(F.col(DAY).isin(known))
    if report == WEEKLY:
        rows = rows.where(F.col("animal_type") == "heifer")
        states = day_states(rows, numbers, week_bands(spark), week_cond(), week_spans())
    else:
        states = day_states(rows, numbers, month_bands(spark), month_cond(), month_spans())
    refresh_partitions(states, path, DAY, known)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    schema = "b_label string, bucket bigint, bits binary, n bigint, weight_sum double, day string"
    return spark.read.schema(schema).parquet(path) if has_data(spark, path, DAY) else spark.createDataFrame([], schema)


def weekly_coverage_of_states(states: DataFrame, herd: DataFrame, today: dt.date, herd_date: str = "date") -> DataFrame:
    """`weekly_coverage` from weekly day states instead of the master."""
    bands = week_bands(states.sparkSession)
    return week_result(bands, herd, merged_stats(states, bands, today.replace(day=1), today), today, herd_date)


def month_groups_of_states(states: DataFrame, herd: DataFrame, month_start: dt.date, month_end: dt.date, herd_date: str = "date") -> DataFrame:
    """`month_groups` from monthly day states instead of the master."""
    bands = month_bands(states.sparkSession)
    return month_groups_result(bands, herd, merged_stats(states, bands, month_start, month_end), month_start, herd_date)
