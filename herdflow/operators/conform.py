"""Conform to the master schema, range filters and tag filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.functions.numbers import non_negative, numeric_col, to_small
from herdflow.functions.text import (drop_dot_zero, drop_leading_zeros, is_valid_tag, null_tokens,
                                     strip_ws)
from herdflow.schemas import MASTER_SCHEMA

NON_NEGATIVE = ("age_days", "age_month", "dim")


def _date_col(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return F.try_to_date(null_tokens(name, "conform"), "yyyy-MM-dd")


def conform(df: DataFrame, loaded_at, schema: T.StructType = MASTER_SCHEMA,
            add_missing: bool = True) -> DataFrame:
    """Project to `schema` in its order.

    `weight` is renamed to `weight_kg` when the latter is absent; text columns are
    stripped and the conform null tokens become null; numbers are coerced (invalid ->
    null), narrowed to smallint/tinyint (fraction or overflow -> null); negative
    age_days / age_month / dim -> null; `loaded_at` is one literal for the batch;
    columns outside the schema are dropped; missing ones are typed nulls (or left
    out with ``add_missing=False``).
    """
    if "weight" in df.columns and "weight_kg" not in df.columns:
        df = df.withColumnRenamed("weight", "weight_kg")
    cols = []
    for f in schema.fields:
        name, dt = f.name, f.dataType
        if name == "loaded_at":
            cols.append(F.lit(loaded_at).cast(dt).alias(name))
            continue
        if name not in df.columns:
            if add_missing:
                cols.append(F.lit(None).cast(dt).alias(name))
            continue
        if isinstance(dt, T.StringType):
            e = null_tokens(name, "conform")
        elif isinstance(dt, T.DateType):
            e = _date_col(df, name)
        elif isinstance(dt, T.DoubleType):
            e = numeric_col(df, name)
        elif isinstance(dt, (T.ShortType, T.ByteType, T.IntegerType)):
            e = to_small(numeric_col(df, name), dt.simpleString())
        else:
            e = F.col(name).cast(dt)
        if name in NON_NEGATIVE:
            e = non_negative(e)
        cols.append(e.cast(dt).alias(name))
    return df.select(*cols)


def filter_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Keep rows with ``low <= col <= high`` (inclusive; null excluded)."""
    return df.where(F.col(col).between(low, high))


def observe_range(df: DataFrame, col: str, low: float, high: float,
                  name: str = "range") -> tuple[DataFrame, Observation]:
    """`filter_range` plus an Observation counting kept and removed rows, filled by
    whatever action consumes the result (no extra pass over the data)."""
    obs = Observation(name)
    inside = F.col(col).between(low, high)
    counted = df.observe(obs, F.count(F.lit(1)).alias("n_in"),
                         F.count_if(F.coalesce(inside, F.lit(False))).alias("n_kept"))
    return counted.where(inside), obs


def range_counts(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """One row: rows inside / outside the range (null counts as outside)."""
    inside = F.coalesce(F.col(col).between(low, high), F.lit(False))
    return df.agg(F.count_if(inside).alias("n_kept"), F.count_if(~inside).alias("n_removed"))


def drop_invalid_tags(df: DataFrame, col: str = "ear_tag") -> DataFrame:
    """Clean the tag (strip, ``.0``, leading zeros) and drop empty / placeholder tags.

    Done in two projections so the stripped value is computed once per row."""
    stripped = df.withColumn(col, strip_ws(col))
    return stripped.withColumn(col, drop_leading_zeros(drop_dot_zero(F.col(col)))).where(is_valid_tag(col))

