"""Repairs of an existing master: classes, null tokens, missing devices, legacy migration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdflow.functions.classify import classify
from herdflow.functions.numbers import non_negative, to_number, to_small
from herdflow.functions.text import clean_tag, null_tokens, source_of
from herdflow.operators.dedup import dedup_latest, latest_order
from herdflow.schemas import (DEDUP_KEYS, LEGACY_CLASSES, LEGACY_DROPS, LEGACY_RENAMES,
                              MASTER_COLUMNS, SOURCE_DEVICE_DEFAULT, STRING_COLUMNS)


def has_legacy_class(df: DataFrame, col: str = "animal_type") -> bool:
    return not df.where(F.col(col).isin(*LEGACY_CLASSES)).isEmpty()


def repair_class(df: DataFrame, col: str = "animal_type", no_col: str = "no",
                 lac_col: str = "lac_no") -> DataFrame:
    """If any row carries a legacy class, recompute the class of *every* row from
    no + lac_no; otherwise return the input unchanged."""
    if not has_legacy_class(df, col):
        return df
    return df.withColumn(col, classify(no_col, lac_col))


def repair_nulls(df: DataFrame, str_cols: list[str] | None = None,
                 neg_cols: tuple[str, ...] = ("age_days", "age_month")) -> DataFrame:
    """Placeholder strings (case-insensitive nan/none/null/nat/<na>/n/a/"") -> null in the
    text columns; negative ages -> null."""
    str_cols = [c for c in (str_cols or STRING_COLUMNS + ["date", "time"])
                if c in df.columns and dict(df.dtypes)[c] == "string"]
    out = df.withColumns({c: null_tokens(c, "repair") for c in str_cols})
    return out.withColumns({c: non_negative(c) for c in neg_cols if c in out.columns})


def repair_null_counts(df: DataFrame, str_cols: list[str] | None = None,
                       neg_cols: tuple[str, ...] = ("age_days", "age_month")) -> DataFrame:
    """One row: cells a `repair_nulls` run would change (text, negative ages)."""
    str_cols = [c for c in (str_cols or STRING_COLUMNS + ["date", "time"])
                if c in df.columns and dict(df.dtypes)[c] == "string"]
    n_str = sum([F.count_if(F.col(c).isNotNull() & null_tokens(c, "repair").isNull())
                 for c in str_cols], F.lit(0))
    n_neg = sum([F.count_if(F.col(c) < 0) for c in neg_cols if c in df.columns], F.lit(0))
    return df.agg(n_str.cast("bigint").alias("n_str_null"), n_neg.cast("bigint").alias("n_negative"))


def fill_device(df: DataFrame, defaults: dict[str, str] = SOURCE_DEVICE_DEFAULT,
                device_col: str = "device", keys: tuple[str, ...] = ("date", "ear_tag"),
                source_col: str = "source") -> DataFrame:
    """Fill a null device from another row with the same (date, ear_tag) — the first in
    master order, i.e. the smallest device — else the source's default, else UNKNOWN.

    The lookup is an aggregate (one row per key); the join is null-safe so null keys
    match each other; rows that already have a device pass through unchanged.
    """
    lookup = (df.where(F.col(device_col).isNotNull()).groupBy(*keys)
              .agg(F.min(device_col).alias("_device_fill")))
    d, l = df.alias("d"), lookup.alias("l")
    cond = None
    for k in keys:
        c = F.col(f"d.{k}").eqNullSafe(F.col(f"l.{k}"))
        cond = c if cond is None else cond & c
    default = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), F.lit(v))])
    filled = F.coalesce(F.col("l._device_fill"), F.try_element_at(default, F.col(f"d.{source_col}")),
                        F.lit("UNKNOWN"))
    j = d.join(l, cond, "left")
    return j.select(*[(F.coalesce(F.col(f"d.{device_col}"), filled) if c == device_col else F.col(f"d.{c}")).alias(c)
                      for c in df.columns])


def repair_device(df: DataFrame, defaults: dict[str, str] = SOURCE_DEVICE_DEFAULT) -> DataFrame:
    """`fill_device`, then keep-latest again on the master key (filled rows may collide)."""
    return dedup_latest(fill_device(df, defaults), DEDUP_KEYS, latest_order())


def round_age_month(df: DataFrame) -> DataFrame:
    return df.withColumn("age_month", F.bround(F.col("age_month").cast("double"), 1))


def migrate_legacy(df: DataFrame, loaded_at) -> DataFrame:
    """Legacy all-text extract -> master layout.

    Trim headers; legacy names -> schema names; drop legacy-only columns; infer source
    from device when absent; classify from no + lac_no; stamp loaded_at; clean no and
    ear_tag (strip, ``.0``, leading zeros; a missing value becomes the text "nan" as in
    the original text export); cast numbers; age_month rounded to 1 decimal; schema
    columns first in schema order, extra columns kept last.
    """
    out = df.toDF(*[c.strip() for c in df.columns])
    out = out.withColumnsRenamed({k: v for k, v in LEGACY_RENAMES.items() if k in out.columns and k != v})
    out = out.drop(*[c for c in LEGACY_DROPS if c in out.columns])
    if "source" not in out.columns and "device" in out.columns:
        out = out.withColumn("source", source_of("device"))
    if "no" in out.columns and "lac_no" in out.columns:
        out = out.withColumn("animal_type", classify("no", "lac_no"))
    else:
        out = out.withColumn("animal_type", F.lit("unknown"))
    out = out.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp"))
    for c in ("no", "ear_tag"):
        if c in out.columns:
            out = out.withColumn(c, clean_tag(F.coalesce(F.col(c).cast("string"), F.lit("nan"))))

    def _opt(c):
        return F.col(c) if c in out.columns else F.lit(None).cast("string")
    out = out.withColumns({
        "weight_kg": to_number(_opt("weight_kg")),
        "age_month": F.bround(to_number(_opt("age_month")), 1),
        "age_days": to_small(_opt("age_days"), "smallint"),
        "dim": to_small(_opt("dim"), "smallint"),
        "lac_no": to_small(_opt("lac_no"), "tinyint"),
    })
    ordered = [c for c in MASTER_COLUMNS if c in out.columns]
    extra = [c for c in out.columns if c not in ordered]
    return out.select(*ordered, *extra)
