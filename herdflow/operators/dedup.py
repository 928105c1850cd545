"""Keep-latest / first per key and duplicate detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


TIEBREAK = ("time", "weight_kg")
#: Columns that two herd rows of one tag can differ in.
HERD_TIEBREAK = ("no", "group_name", "lac_no", "age_days", "dim", "animal_type")


def latest_order(loaded_at: str = "loaded_at", tiebreak: tuple[str, ...] = TIEBREAK) -> list[Column]:
    """Master order for keep-latest: newest load first, a null load time counts as newest
    (it sorts last in an ascending sort and the last row is kept); ties broken by the
    tiebreak columns descending so the survivor is deterministic."""
    return [F.col(loaded_at).desc_nulls_first()] + [F.col(c).desc_nulls_last() for c in tiebreak]


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key (null keys compare equal): the first row in `order`.

    ``row_number() = 1`` plans as WindowGroupLimit on both sides of the shuffle, so every
    map task already keeps one row per key before anything is exchanged — a hot key
    shrinks to one row per map task.
    """
    order = order if order is not None else latest_order()
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in ascending `order` (lookup build)."""
    return dedup_latest(df, keys, order)


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every member of a duplicated key group with the group size `n_dup` (keep=False).

    Counts come from a partial+final aggregate; the members are found by a null-safe
    equi-join against the duplicated keys only — no window buffers a whole hot group.
    """
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_dup"))
              .where(F.col("n_dup") > 1))
    d = df.alias("d")
    c = counts.alias("c")
    j = d.join(c, _null_safe_on(d, c, keys), "inner")
    return j.select("d.*", "c.n_dup")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, duplicated rows (all members), duplicated keys, duplicate rate %."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n_dup_rows"),
        F.count_if(F.col("n") > 1).alias("n_dup_keys"),
    ).select("n_rows", "n_dup_rows", "n_dup_keys",
             F.when(F.col("n_rows") > 0, F.col("n_dup_rows") / F.col("n_rows") * 100)
             .alias("dup_rate_pct"))
