"""DuckDB SQL text of the scalar rules, used only to write the independent oracle queries."""

from __future__ import annotations

NUM_RE = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def strip(x: str) -> str:
    return rf"regexp_replace(CAST({x} AS VARCHAR), '^\s+|\s+$', '', 'g')"


def clean_tag(x: str) -> str:
    return rf"regexp_replace(regexp_replace({strip(x)}, '\.0$', ''), '^0+', '')"


def valid_tag(x: str) -> str:
    return f"({x} IS NOT NULL AND lower({x}) NOT IN ('', 'nan', 'none', 'nat', 'null'))"


def normalize_id(x: str) -> str:
    s = rf"regexp_replace({strip(x)}, '\.0$', '')"
    sci = f"CAST(TRY_CAST(floor(TRY_CAST({s} AS DOUBLE)) AS DECIMAL(38,0)) AS VARCHAR)"
    return (rf"regexp_replace(CASE WHEN regexp_full_match({s}, '\d+\.\d+[eE][+-]\d+') "
            f"THEN {sci} ELSE {s} END, '^0+', '')")


def to_number(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN regexp_full_match({s}, '{NUM_RE}') THEN TRY_CAST({s} AS DOUBLE) END"


def classify(no: str, lac: str) -> str:
    return (f"CASE WHEN {no} IS NULL OR lower({strip(no)}) IN ('', 'nan', 'none') THEN 'unknown' "
            f"WHEN {to_number(lac)} >= 1 THEN 'cow' ELSE 'heifer' END")


def null_conform(x: str) -> str:
    return f"CASE WHEN {strip(x)} IN ('nan', 'None', 'NaT', '') THEN NULL ELSE {strip(x)} END"


def null_repair(x: str) -> str:
    return (f"CASE WHEN lower({strip(x)}) IN ('nan', 'none', 'null', 'nat', '<na>', 'n/a', '') "
            f"THEN NULL ELSE {x} END")


def non_negative(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN {x} END"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
