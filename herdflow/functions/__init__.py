"""Scalar Column functions (all JVM built-ins; no Python UDF)."""

from herdflow.functions.blob import is_valid_line, normalize_newlines, parse_weigh_line
from herdflow.functions.classify import add_animal_type, classify
from herdflow.functions.dates import (age_month, coverage_threshold, day_diff, file_date,
                                      fmt_date, fmt_pct, is_month_end, month_end,
                                      month_start, parse_dmy, week_of_month, year_month)
from herdflow.functions.numbers import (decimal_comma, non_negative, small_reject, to_number,
                                        to_small)
from herdflow.functions.text import (clean_tag, is_valid_tag, normalize_id, null_tokens,
                                     safe_name, session_id, source_of, strip_ws)

__all__ = [
    "add_animal_type", "age_month", "classify", "clean_tag", "coverage_threshold", "day_diff", "decimal_comma",
    "file_date", "fmt_date", "fmt_pct", "is_month_end", "is_valid_line", "is_valid_tag",
    "month_end", "month_start", "non_negative", "normalize_id", "normalize_newlines",
    "null_tokens", "parse_dmy", "parse_weigh_line", "safe_name", "session_id", "small_reject",
    "source_of", "strip_ws", "to_number", "to_small", "week_of_month", "year_month",
]
