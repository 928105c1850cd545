"""Animal class from herd number and lactation number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from herdflow.functions.numbers import numeric_col, to_number
from herdflow.functions.text import col_, strip_ws
from herdflow.schemas import UNKNOWN_NO_TOKENS


def classify(no: Column | str, lac_no: Column | str, lac_is_number: bool = False) -> Column:
    """unknown when `no` is missing or a placeholder; cow when lac_no >= 1; else heifer.

    A NaN or non-numeric lac_no counts as heifer (NaN is nulled by `to_number`).
    """
    n = col_(no)
    unknown = n.isNull() | F.lower(strip_ws(n)).isin(*UNKNOWN_NO_TOKENS)
    return (F.when(unknown, F.lit("unknown"))
            .when((col_(lac_no) if lac_is_number else to_number(lac_no)) >= 1, F.lit("cow"))
            .otherwise(F.lit("heifer")))


def add_animal_type(df, no_col: str = "no", lac_col: str = "lac_no", out: str = "animal_type"):
    """Add the class column; when either input column is missing every row is unknown."""
    if no_col in df.columns and lac_col in df.columns:
        return df.withColumn(out, classify(no_col, numeric_col(df, lac_col), lac_is_number=True))
    return df.withColumn(out, F.lit("unknown"))
