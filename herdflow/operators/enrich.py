"""Herd enrichment (left equi-join on normalised identifiers) and back-dating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdflow.functions.dates import age_month, day_diff
from herdflow.functions.numbers import numeric_col
from herdflow.functions.text import with_normalized_id

HERD_OUT = ["no", "group_name", "age_days", "dim", "lac_no"]


def enrich(weights: DataFrame, herd: DataFrame | None, left_key: str = "ear_tag",
           right_key: str = "transp_2", date_col: str = "date", snapshot_col: str = "date",
           today=None) -> DataFrame:
    """Left join weigh rows to one herd snapshot and back-date age and DIM.

    * keys on both sides go through `normalize_id`; the normalised tag replaces the original;
    * duplicate herd rows fan out (plain left join);
    * a row counts as matched only when the herd `no` is not null: only then are
      age_days and dim reduced by ``day_diff = snapshot date - weigh date``;
    * ``age_month = round(age_days / 30.44, 1)`` for every row;
    * no herd -> the herd columns are null and nothing else changes.

    Join strategy is left to the planner: the herd side is broadcast only when its size
    estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (or AQE sees it is small at
    run time); otherwise a sort-merge join, with AQE splitting a skewed tag.
    """
    if herd is None:
        out = weights
        for c in ["no", "group_name", "age_days", "age_month", "dim", "lac_no"]:
            out = out.withColumn(c, F.lit(None).cast("string"))
        return out

    snap = (F.col(snapshot_col).cast("date") if snapshot_col in herd.columns
            else (F.lit(today).cast("date") if today is not None else F.current_date()))
    keep = [c for c in HERD_OUT if c in herd.columns]
    h = with_normalized_id(herd, right_key, "_hkey")
    h = h.select("_hkey", *[numeric_col(h, c).alias(f"_{c}_num") if c in ("age_days", "dim")
                            else F.col(c) for c in keep], snap.alias("_snap_date"))
    w = with_normalized_id(weights.drop(*[c for c in HERD_OUT if c in weights.columns]), left_key)
    j = w.join(h, w[left_key] == h["_hkey"], "left")

    matched = F.col("no").isNotNull() if "no" in keep else F.lit(False)
    dd = day_diff("_snap_date", F.col(date_col).cast("date"))
    out = j
    for c in ("age_days", "dim"):
        if c in keep:
            out = out.withColumn(c, F.when(matched, F.col(f"_{c}_num") - dd).otherwise(F.col(f"_{c}_num")))
    out = out.withColumn("age_month", age_month("age_days") if "age_days" in keep
                         else F.lit(None).cast("double"))
    return out.drop("_hkey", "_snap_date", "_age_days_num", "_dim_num")


def match_counts(df: DataFrame, no_col: str = "no") -> DataFrame:
    """One row: total, matched, unmatched and their percentages (null rate on empty input)."""
    n = F.count(F.lit(1))
    m = F.count(F.col(no_col))
    return df.agg(n.alias("total"), m.alias("matched"), (n - m).alias("unmatched")).select(
        "total", "matched", "unmatched",
        F.when(F.col("total") > 0, F.round(F.col("matched") / F.col("total") * 100, 1)).alias("matched_pct"),
        F.when(F.col("total") > 0, F.round(F.col("unmatched") / F.col("total") * 100, 1)).alias("unmatched_pct"),
    )
