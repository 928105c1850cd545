import hashlib
import re

import pytest

from herdflow.llm import fingerprints as fp
from herdflow.llm.queries import op3_fingerprints


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"



def paragraphs(text):
    return {p for p in re.split(r"\n|(?<=[.!?] )(?=[A-M])", text or "") if p.strip(" ")}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    order = sorted(docs, reverse=True)
    texts = dict(docs)
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    by_text = {}
    for i, d in enumerate(order):
        d = d[0]
        text, nxt = texts[d] or "", texts[order[(i + 1) % len(order)][0]] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        r = got[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(text, edited), abs=1e-12)
        assert r.near_next == pytest.approx(likeness(text, nxt), abs=1e-12)
        for t, f in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert by_text.setdefault(t, f) == f
    assert len(set(by_text.values())) == len(by_text)


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(op3_fingerprints(spark, sf).collect(), docs)


def test_many_ranges_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 3)
    docs = [(1, None), (2, ""), (3, "\n\n \n"), (5, "One. Two. Three.\nfour"), (8, "日本語🙂\nÉté. Alors. Bon"), (900, "x"), (901, "x"),
            (-7, "a\nb\na\nb"), (10**15, "Line\n" * 40 + "end"), (10**15 + 1, "\n".join(f"line {i}" for i in range(900)))]
    docs += [(100 + i, "\n".join(f"shared {j}" if j % 9 else f"own {i} {j}" for j in range(60))) for i in range(20)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n_chars long, fingerprint string")
    check(fp.fingerprints(df).collect(), docs)


def test_null_ids_repeats_one_row_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (2, "c")], "doc_id long, text string")
    rows = fp.fingerprints(df).collect()
    assert sorted((r.doc_id or 0, r.near_next) for r in rows) == [(0, 0.0), (1, 0.0), (1, 1.0), (2, 0.0)]
    one = fp.fingerprints(df.filter("doc_id = 2")).collect()
    assert [(r.n_chars, r.near_edited, r.near_next) for r in one] == [(1, 1.0, 1.0)]
    assert len(fp.fingerprints(df.filter("doc_id IS NULL")).collect()) == 1
    assert fp.fingerprints(df.limit(0)).collect() == []


def test_recovered_digests(spark):
    rows = [(i, list(range(1000, 1000 + 3 * i)), list(range(1000 + i, 1000 + 5 * i))) for i in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "id long, a array<long>, b array<long>").selectExpr(
        "id", "transform(a, k -> xxhash64(k)) a", "transform(b, k -> xxhash64(k)) b")
    want = {r.id: (set(r.a) - set(r.b), set(r.b) - set(r.a)) for r in df.collect()}
    got = fp.differences(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (set(r.only_a), set(r.only_b)) == want[r.id]
        assert len(r.only_a) + len(r.only_b) == sum(map(len, want[r.id]))


def test_main_path_is_native(spark, sf):
    plan = op3_fingerprints(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_only_unfinished_groups_keep_their_digests(spark, monkeypatch):
    """What is staged of a group that peels is what was found, and the fingerprints' numbers come without the digests."""
    kept = []

    def staged(df, name, real=fp.staged):
        out = real(df, name)
        kept.append((name, out))
        return out

    monkeypatch.setattr(fp, "staged", staged)
    monkeypatch.setattr(fp, "differences", None)
    docs = [(i, "\n".join(f"line {i} {j}" for j in range(40))) for i in range(6)]
    check(fp.fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
    peeled = [df for name, df in kept if name == "peeled"]
    assert peeled and all(df.filter("ok AND (a IS NOT NULL OR b IS NOT NULL)").isEmpty() for df in peeled)
