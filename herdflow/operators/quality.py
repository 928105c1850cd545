"""Data-quality checks and profiles. Each check is one aggregate over the data; only
one-row results (or one row per column) reach the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.functions.text import strip_ws
from herdflow.schemas import JOIN_RATE_MIN, JOIN_RATE_MIN_ROWS, local_table


def expect_non_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def expect_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Missing required columns (empty list = ok)."""
    return [c for c in cols if c not in df.columns]


def _per_column(df: DataFrame, cols: list[str], stats: dict[str, Callable[[str], Column]]) -> DataFrame:
    """One aggregate computing every per-column statistic, unpivoted to one row per column."""
    aggs = [fn(c).alias(f"{name}__{i}") for name, fn in stats.items() for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              *[F.col(f"{name}__{i}").alias(name) for name in stats])
                     for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: number of nulls."""
    return _per_column(df, cols or df.columns, {"n_null": lambda c: F.count_if(_c(c).isNull())})


def all_null_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: non-null count and whether the column is entirely null."""
    out = _per_column(df, cols or df.columns, {"n_non_null": lambda c: F.count(_c(c))})
    return out.withColumn("all_null", F.col("n_non_null") == 0)


def profile_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: nulls, literal "nan" strings (any case, stripped), data type."""
    prof = _per_column(df, cols, {
        "n_null": lambda c: F.count_if(_c(c).isNull()),
        "n_nan_str": lambda c: F.count_if(F.lower(strip_ws(_c(c))) == "nan"),
    })
    types = local_table(df.sparkSession, [(c, df.schema[c].dataType.simpleString()) for c in cols],
                        T.StructType([T.StructField("column", T.StringType()),
                                      T.StructField("dtype", T.StringType())]))
    return prof.join(F.broadcast(types), "column")


def summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def join_rate_status(total: int, matched: int, threshold: float = JOIN_RATE_MIN, min_rows: int = JOIN_RATE_MIN_ROWS) -> str:
    """The gate's status from counts that an observation took."""
    if total < min_rows:
        return "skipped"
    return "ok" if matched / total >= threshold else "alert"


def join_rate_gate(df: DataFrame, threshold: float = JOIN_RATE_MIN,
                   min_rows: int = JOIN_RATE_MIN_ROWS, no_col: str = "no") -> DataFrame:
    """One row: total, matched, rate and status. Skipped when the key column is missing or
    there are fewer than `min_rows` rows; a failing rate only alerts."""
    if no_col not in df.columns:
        return df.sparkSession.createDataFrame(
            [(None, None, None, "skipped", True)],
            "total bigint, matched bigint, rate double, status string, ok boolean")
    agg = df.agg(F.count(F.lit(1)).alias("total"), F.count(no_col).alias("matched"))
    rate = F.when(F.col("total") > 0, F.col("matched") / F.col("total"))
    status = (F.when(F.col("total") < min_rows, F.lit("skipped"))
              .when(rate >= threshold, F.lit("ok")).otherwise(F.lit("alert")))
    return agg.select("total", "matched", F.round(rate, 4).alias("rate"), status.alias("status"),
                      (status != "alert").alias("ok"))


def profile_change(df: DataFrame, after: dict[str, Column], nan_text: str = "nan") -> DataFrame:
    """What a normalisation does to columns: a row a column, from one pass over the pairs (before, after).

    Nulls and `nan_text` texts before and after; `n_changed` rows whose value differs (null-safe) and those of them that are
    `n_newly_null`; distinct values before and after, and `n_newly_equal`, how many values fall together with another.

    The values of all columns go into one aggregate by (column, side, value), which is shuffled by value, and the totals are
    taken from its rows. Rows are spread evenly first, so no task holds the distinct values of more than its share.
    """
    types = {c: (df.schema[c].dataType, df.select(a.alias("a")).schema["a"].dataType) for c, a in after.items()}
    at = {c: i for i, c in enumerate(after)}
    kinds = sorted({t.simpleString() for pair in types.values() for t in pair})

    def entry(c: str, side: int) -> Column:
        b, a = F.col(f"b{at[c]}"), F.col(f"a{at[c]}")
        own, other = (b, a) if side == 0 else (a, b)
        is_nan = F.coalesce(F.lower(strip_ws(own.cast("string"))) == nan_text, F.lit(False))
        values = [(own if types[c][side].simpleString() == k else F.lit(None).cast(k)).alias(f"v{i}") for i, k in enumerate(kinds)]
        return F.struct(F.lit(f"{side}{c}").alias("of"), *values, own.isNull().alias("null"), is_nan.alias("nan"),
                        other.isNotNull().alias("paired"), (~b.eqNullSafe(a)).alias("changed"))

    # each normalisation is worked out once a row
    pairs = df.hint("rebalance").select(*[_c(c).alias(f"b{i}") for c, i in at.items()], *[after[c].alias(f"a{i}") for c, i in at.items()])
    entries = pairs.select(F.inline(F.array(*[entry(c, side) for c in after for side in (0, 1)])))
    found = entries.groupBy("of", *[f"v{i}" for i in range(len(kinds))], "null").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("nan").alias("n_nan"), F.count_if("changed").alias("n_changed"),
        F.count_if("paired").alias("n_paired"))

    def total(side: int, n: str, cond: Column | None = None) -> Callable[[str], Column]:
        def fn(c: str) -> Column:
            of = F.col("of") == f"{side}{c}"
            return F.coalesce(F.sum(F.when(of if cond is None else of & cond, F.col(n))), F.lit(0))
        return fn

    def distinct(side: int, paired: bool = False) -> Callable[[str], Column]:
        def fn(c: str) -> Column:
            of = (F.col("of") == f"{side}{c}") & ~F.col("null")
            return F.count_if(of & (F.col("n_paired") > 0) if paired else of)
        return fn

    null = F.col("null")
    return _per_column(found, list(after), {
        "nulls_before": total(0, "n", null), "nulls_after": total(1, "n", null),
        "nan_text_before": total(0, "n_nan"), "nan_text_after": total(1, "n_nan"),
        "n_changed": total(0, "n_changed"), "n_newly_null": total(1, "n_paired", null),
        "distinct_before": distinct(0), "distinct_after": distinct(1),
        "n_newly_equal": lambda c: distinct(0, True)(c) - distinct(1, True)(c),
    })


def probe(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Readable-table probe: row count per named parquet path, or the error text."""
    rows = []
    for name, p in paths.items():
        try:
            rows.append((name, p, spark.read.parquet(p).count(), None))
        except Exception as e:  # noqa: BLE001 - a probe reports, it does not raise
            rows.append((name, p, None, str(e)))
    return spark.createDataFrame(rows, "name string, path string, n_rows bigint, error string")


def landing_stats(df: DataFrame, op_col: str = "operationTag") -> DataFrame:
    """One row: rows, distinct non-blank operations, rows without an operation."""
    blank = F.coalesce(F.trim(F.col(op_col)) == "", F.lit(True))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(F.when(~blank, F.col(op_col))).alias("n_operations"),
                  F.count_if(blank).alias("n_direct"))


def preview(df: DataFrame, n: int = 10, order: list[str] | None = None, tail: bool = False) -> DataFrame:
    """First (or last, ``tail=True``) `n` rows in `order` — a top-n report, planned as
    TakeOrderedAndProject (each task keeps its own n rows)."""
    cols = order or df.columns
    sort = [F.col(c).desc_nulls_first() if tail else F.col(c).asc_nulls_last() for c in cols]
    return df.orderBy(*sort).limit(n)
