"""String scalars: identifiers, null tokens, names. All built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdflow.schemas import (CONFORM_NULL_TOKENS, INVALID_TAG_TOKENS,
                              REPAIR_NULL_TOKENS)

SCI_ID_RE = r"^\d+\.\d+[eE][+-]\d+$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Whitespace removed by strip: the ASCII blanks and separators, and Unicode's blanks.
WHITESPACE = (" \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
              "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: Column | str) -> Column:
    """Strip leading/trailing whitespace including tabs and newlines (plain `trim` only
    removes blanks). A character-set trim, no regex."""
    return F.trim(col_(c).cast("string"), F.lit(WHITESPACE))


def drop_dot_zero(s: Column) -> Column:
    """Remove one trailing ``.0`` (the input is named once, so nested calls stay small)."""
    return F.regexp_replace(s, r"\.0\z", "")


def drop_leading_zeros(s: Column) -> Column:
    return F.ltrim(s, F.lit("0"))


def clean_tag(c: Column | str) -> Column:
    """strip -> drop a trailing ``.0`` -> drop leading zeros."""
    return drop_leading_zeros(drop_dot_zero(strip_ws(c)))


def is_valid_tag(c: Column | str) -> Column:
    """False for null and for the tokens '', nan, none, nat, null (any case)."""
    c = col_(c)
    return c.isNotNull() & ~F.lower(c).isin(*INVALID_TAG_TOKENS)


def normalize_id(c: Column | str) -> Column:
    """Identifier normalisation used on both sides of the herd join.

    strip -> drop ``.0`` -> ``d.ddde+NN`` to its integer digits -> drop leading zeros.
    Null stays null. Scientific form needs a decimal point (``9e+14`` is left as is).
    """
    return sci_to_digits(drop_dot_zero(strip_ws(c)))


def sci_to_digits(s: Column) -> Column:
    """Second half of `normalize_id` on an already stripped, ``.0``-free value."""
    as_int = F.floor(s.try_cast("double").try_cast("decimal(38,6)")).cast("string")
    return drop_leading_zeros(F.when(s.rlike(SCI_ID_RE), as_int).otherwise(s))


#: Column metadata of a value that `with_normalized_id` has made.
NORMALIZED = {"normalized_id": True}


def with_normalized_id(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """`normalize_id` of a column; the result is marked, and a marked column is taken as it is."""
    out = out or col
    done = col in df.columns and df.schema[col].metadata.get("normalized_id")
    value = F.col(col) if done else normalize_id(col)
    return df.withColumn(out, value.alias(out, metadata=NORMALIZED))


def null_tokens(c: Column | str, vocab: str = "conform") -> Column:
    """Null out placeholder strings.

    ``conform``: exact tokens nan / None / NaT / "" after strip (value is stripped).
    ``repair``: case-insensitive nan / none / null / nat / <na> / n/a / "" (value kept as is).
    """
    s = strip_ws(c)
    if vocab == "conform":
        return F.when(~s.isin(*CONFORM_NULL_TOKENS), s)
    if vocab == "repair":
        return F.when(~F.lower(s).isin(*REPAIR_NULL_TOKENS), col_(c))
    raise ValueError(f"unknown vocabulary {vocab!r}")


def safe_name(c: Column | str, strict: bool = False) -> Column:
    """File-safe name: ``\\ / : * ? " < > |`` -> ``_``; strict also whitespace, then strip ``_``."""
    if strict:
        s = F.regexp_replace(col_(c), r'[\\/:*?"<>|\s]', "_")
        return F.regexp_replace(s, r"^_+|_+$", "")
    return F.regexp_replace(col_(c), r'[\\/:*?"<>|]', "_")


def source_of(device: Column | str) -> Column:
    """GALLAGHER when the device name contains it, else PTM."""
    d = col_(device)
    return F.when(F.upper(d).contains("GALLAGHER"), F.lit("GALLAGHER")).otherwise(F.lit("PTM"))


def session_id(href: Column | str) -> Column:
    """Numeric id from the last ``/`` segment of an href; null when not an integer."""
    last = F.element_at(F.split(col_(href), "/"), -1)
    return F.when(last.rlike(r"^\d+$"), last.try_cast("bigint"))
