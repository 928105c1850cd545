"""Weigh-line scalars for text blobs of the form ``seq; weight,dec;TR:tag;DD/MM/YYYY;HH:MM;S``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from herdflow.functions.dates import parse_dmy
from herdflow.functions.numbers import decimal_comma
from herdflow.functions.text import col_, strip_ws
from herdflow.schemas import BLOB_HEADER_KEYWORDS


def normalize_newlines(c: Column | str) -> Column:
    """Null blob -> ''; CRLF and CR -> LF."""
    t = F.coalesce(col_(c).cast("string"), F.lit(""))
    return F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def is_valid_line(c: Column | str) -> Column:
    """Drop blank/short lines and lines containing a header/footer keyword anywhere."""
    c = col_(c)
    u = F.upper(c)
    has_kw = reduce(lambda a, b: a | b, [u.contains(k) for k in BLOB_HEADER_KEYWORDS])
    return (F.length(strip_ws(c)) >= 2) & ~has_kw


def line_fields(c: Column | str) -> Column:
    """Fields split on ';', each stripped."""
    return F.transform(F.split(strip_ws(c), ";"), lambda x: strip_ws(x))


def tag_field(f: Column) -> Column:
    """The tag only when the field starts with ``TR:`` (every ``TR:`` removed), else ''."""
    return F.when(f.startswith("TR:"), F.replace(f, F.lit("TR:"), F.lit(""))).otherwise(F.lit(""))


def parse_weigh_line(c: Column | str) -> Column:
    """Struct (stt, weight, ear_tag, date, time, n_fields) of one weigh line."""
    f = line_fields(c)
    return F.struct(
        F.get(f, 0).alias("stt"),
        decimal_comma(F.get(f, 1)).alias("weight"),
        tag_field(F.get(f, 2)).alias("ear_tag"),
        parse_dmy(F.get(f, 3)).alias("date"),
        F.get(f, 4).alias("time"),
        F.size(f).alias("n_fields"),
    )
