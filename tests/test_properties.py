"""Property tests: Spark scalars against plain-Python statements of the same rules."""
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from herdflow.functions.classify import classify
from herdflow.functions.numbers import to_number
from herdflow.functions.text import clean_tag, normalize_id, null_tokens

WS = " \t\n\r\f\x0b"
NUM = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")
SCI = re.compile(r"\d+\.\d+[eE][+-]\d+")

pieces = st.sampled_from(["0", "00", "1", "9", ".", ".0", "e", "E", "+", "-", " ", "\t", "\n", "a", "nan",
                          "None", "NaT", "12", "3.5", "e+14", "9.82", "07"])
texts = st.lists(pieces, min_size=0, max_size=6).map("".join)


def py_strip(s):
    return s.strip(WS)


def py_clean(s):
    s = py_strip(s)
    if s.endswith(".0"):
        s = s[:-2]
    return s.lstrip("0")


def py_normalize(s):
    s = py_strip(s)
    if s.endswith(".0"):
        s = s[:-2]
    if SCI.fullmatch(s):
        f = float(s)
        if math.isfinite(f) and abs(f) < 1e30:
            s = str(math.floor(f))
        else:
            return "skip"
    return s.lstrip("0")


def py_number(s):
    s = py_strip(s)
    return float(s) if NUM.fullmatch(s) else None


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", fn("v")).orderBy("i").collect()]


@settings(max_examples=30, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_clean_tag_rule(spark, values):
    assert _eval(spark, values, clean_tag) == [py_clean(v) for v in values]


@settings(max_examples=30, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_normalize_id_rule(spark, values):
    got = _eval(spark, values, normalize_id)
    for v, g in zip(values, got):
        want = py_normalize(v)
        if want != "skip":
            assert g == want, (v, g, want)


@settings(max_examples=30, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_to_number_rule(spark, values):
    got = _eval(spark, values, to_number)
    for v, g in zip(values, got):
        want = py_number(v)
        assert (g is None and want is None) or (g is not None and want is not None and
                                                 (g == want or (math.isinf(g) and math.isinf(want)))), (v, g, want)


@settings(max_examples=30, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_null_token_rules(spark, values):
    conform = _eval(spark, values, lambda c: null_tokens(c, "conform"))
    repair = _eval(spark, values, lambda c: null_tokens(c, "repair"))
    for v, c, r in zip(values, conform, repair):
        s = py_strip(v)
        assert c == (None if s in ("nan", "None", "NaT", "") else s)
        assert r == (None if s.lower() in ("nan", "none", "null", "nat", "<na>", "n/a", "") else v)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), texts), st.one_of(st.none(), texts)), min_size=1, max_size=40))
def test_classify_rule(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, no string, lac string")
    got = [r[0] for r in df.orderBy("i").select(classify("no", "lac")).collect()]
    for (no, lac), g in zip(pairs, got):
        if no is None or py_strip(no).lower() in ("", "nan", "none"):
            want = "unknown"
        else:
            x = py_number(lac) if lac is not None else None
            want = "cow" if x is not None and x >= 1 else "heifer"
        assert g == want, (no, lac, g, want)
