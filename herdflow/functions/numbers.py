"""Numeric coercion with a lexical guard (ANSI-safe, NaN-safe)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.functions.text import col_, strip_ws

# Accepts what a decimal number looks like; rejects Java-only forms such as "2d",
# "NaN" and "Infinity" so NaN never reaches sums, averages or comparisons.
NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

SMALL_RANGES = {"tinyint": (-128, 127), "smallint": (-32768, 32767), "int": (-(2 ** 31), 2 ** 31 - 1)}


def to_number(c: Column | str) -> Column:
    """String or number -> double; anything not a plain decimal/scientific literal -> null."""
    s = strip_ws(c)
    return F.when(s.rlike(NUMBER_RE), s.try_cast("double"))


def decimal_comma(c: Column | str) -> Column:
    """Decimal comma -> point (every comma), then `to_number`."""
    return to_number(F.replace(col_(c).cast("string"), F.lit(","), F.lit(".")))


def to_small(c: Column | str, type_: str = "smallint") -> Column:
    """Narrow to an integral type; a fraction or an overflow gives null (see `small_reject`)."""
    lo, hi = SMALL_RANGES[type_]
    x = to_number(c)
    return F.when((x == F.floor(x)) & x.between(lo, hi), x.cast(type_))


def small_reject(c: Column | str, type_: str = "smallint") -> Column:
    """True where a number exists but cannot be narrowed (counted as a reject)."""
    return to_number(c).isNotNull() & to_small(c, type_).isNull()


def non_negative(c: Column | str) -> Column:
    c = col_(c)
    return F.when(c >= 0, c)


_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                  T.DecimalType)


def numeric_col(df: DataFrame, name: str) -> Column:
    """Column `name` of `df` as double: numbers are cast directly (NaN -> null), text goes
    through `to_number`'s lexical guard."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c.cast("double"))
    if isinstance(dt, _NUMERIC_TYPES):
        return c.cast("double")
    return to_number(c)
