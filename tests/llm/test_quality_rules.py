import random
import re
from collections import Counter

import duckdb
import pytest

from herdflow.llm.queries import op12_quality_rules
from herdflow.llm.quality_rules import BASE_RULES, COUNTS, RULES, Rule, judge, judge_sql, keep_good, stop_forms


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    held = {j for i, x in enumerate(win) if n[x] > 1 for j in range(i, i + 5)}
    ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": len(ls) - len(set(ls)), "n_repeat_words": len(held), "n_marks": len(re.findall("[!?]", t)),
            "n_bare_words": sum(not any(c.isalpha() for c in x) for x in w),
            "n_stop_words": sum(x in set(stop_forms()) for x in w), "n_lines": len(ls),
            "n_cut_lines": sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*\Z", x)) for x in ls),
            "n_bullets": sum(bool(re.match(r"[\x20\x09-\x0D]*[-*•·‣▪][\x20\x09]", x)) for x in ls)}


def fails(rule, n):
    part, whole = (100 * n[rule.part], n[rule.whole]) if rule.whole else (n[rule.part], 1)
    if whole < rule.since:
        return False
    return (rule.low is not None and part < rule.low * whole) or (rule.high is not None and part > rule.high * whole)


def check(rows, texts):
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(i for i in texts if i is not None)
    for r in rows:
        n = plain(texts[r.doc_id])
        assert {c: r[c] for c in COUNTS} == n
        broken = [x.name for x in [*BASE_RULES, *RULES] if fails(x, n)]
        assert r.failed_rules == " ".join(broken)
        assert r.base_failed == (n["n_words"] < 10 or 100 * n["n_repeat_words"] > 20 * n["n_words"])
        assert r.kept == (not broken)


ODD = {
    1: None, 2: "", 3: "   \n\t \n", 4: "one", 5: "a b c d e", 6: "a b c d e a b c d e", 7: "x " * 40, 8: "x x x x x x",
    9: "a line\na line\n a line\na line \n\n\nother...\n- bullet\n* b\n•\tc", 10: "é ü 漢字   𝒳𝒴 #*$%&|<> !? | - 12 3.4",
    11: "The the THE of und, y.", 12: "p q r s t u p q r s t v p q r s t w " * 2, 13: "a\rb\x0bc\x0cd\x1ce\x85f g h i j k l",
    None: "null id " * 3,
}


def test_whole_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(op12_quality_rules(spark, sf).collect(), docs)


def test_odd_texts(spark):
    rng = random.Random(3)
    texts = dict(ODD) | {100 + i: " ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for i in range(60)}
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(texts.items())], "doc_id long, text string, t int")
    check(judge(df.withColumns({c: df.t for c in ["row", "w", "ls", "h", "n_words", "kept"]})).collect(), texts)


def test_long_text(spark):
    rng = random.Random(5)
    w = [str(rng.randrange(50_000)) for _ in range(100_000)] * 2
    r = judge(spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")).first()
    assert (r.n_words, r.n_repeat_words, r.base_failed) == (200_000, 200_000, True)


def test_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(ODD.items()))
    got = con.execute(judge_sql()).fetchall()
    df = spark.createDataFrame(list(ODD.items()), "doc_id long, text string")
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in judge(df).collect())


def test_empty_and_repeated_rows(spark):
    assert judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = judge(spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words) for r in rows) == [(1, 1), (1, 2), (1, 2)]


def test_kept_rows_have_all_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.withColumns({"row": docs.lang, "t": docs.doc_id, "w": docs.lang, "counts": docs.lang, "a.b": docs.lang})
    kept = keep_good(odd)
    assert kept.columns == odd.columns
    want = {r.doc_id for r in judge(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_own_table(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a # # #")], "doc_id long, text string")
    rows = judge(df, [Rule("sym", "n_symbols", "n_words", high=50)], [Rule("few", "n_words", low=2)]).collect()
    assert [(r.kept, r.failed_rules) for r in sorted(rows)] == [(True, ""), (False, "sym")]


def test_quality_labels_and_plan(spark):
    """Rows labelled good break no rule but the base ones; labelled bad ones are dropped."""
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    found = {r.doc_id: r for r in judge(docs).collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    good = [found[d] for d, q in quality.items() if q == 1]
    bad = [found[d] for d, q in quality.items() if q == 0]
    assert all(r.kept or r.base_failed for r in good)
    assert sum(r.kept for r in bad) <= 0.05 * len(bad)
    plan = judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
