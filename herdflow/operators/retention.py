"""Retention plan: which landed sessions to remove upstream, oldest first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdflow.operators.windows import running_total
from herdflow.schemas import RETENTION_BUFFER, RETENTION_THRESHOLD
from herdflow.sources.sessions import deletable


def listing_total(listing: DataFrame, count_col: str = "animalCount") -> DataFrame:
    return listing.agg(F.sum(F.coalesce(F.col(count_col), F.lit(0))).cast("bigint").alias("total"))


def select_for_retention(listing: DataFrame, landed: DataFrame,
                         threshold: int = RETENTION_THRESHOLD, buffer: int = RETENTION_BUFFER,
                         created_col: str = "createdAt", count_col: str = "animalCount",
                         href_col: str = "href", landed_id_col: str = "session_id") -> DataFrame:
    """Sessions to remove.

    Nothing when the total over all listed sessions is at most `threshold`. Otherwise,
    walking the *landed* sessions oldest first (createdAt, then id; a missing createdAt
    sorts first), a session is taken while the remaining total is still above
    ``threshold - buffer``; ``remaining_after`` is the estimate after removing it.
    """
    target = threshold - buffer
    # One scalar: the listing total decides whether anything runs at all.
    total = listing_total(listing, count_col).first()["total"] or 0
    cand = (deletable(listing, landed, href_col, landed_id_col)
            .withColumn("_cnt", F.coalesce(F.col(count_col), F.lit(0)).cast("bigint"))
            .withColumn("_created", F.coalesce(F.col(created_col), F.lit(""))))
    out_cols = [*listing.columns, "session_id"]
    if total <= threshold:
        return cand.select(*out_cols, F.lit(0).cast("bigint").alias("remaining_after"),
                           F.lit(total).cast("bigint").alias("total_before")).where(F.lit(False))
    ranked = running_total(cand, ["_created", "session_id"], "_cnt", out="_before")
    remaining = F.lit(total) - F.col("_before")
    return (ranked.where(remaining > target)
            .select(*out_cols, (remaining - F.col("_cnt")).cast("bigint").alias("remaining_after"),
                    F.lit(total).cast("bigint").alias("total_before")))
