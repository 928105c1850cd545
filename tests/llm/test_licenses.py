import pytest  # noqa: I001
import random
import re

from herdflow.llm.licenses import NOTICES, SHINGLE, bands, scan, scan_sql, size_class, stride
from herdflow.llm.queries import op7_license_scan


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"



def words(t):
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, notices=NOTICES, least=0.8):
    out = {}
    for i, (name, wording) in enumerate(notices):
        w = words(wording)
        k = min(SHINGLE, len(w))
        own = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
        size = size_class(len(own))
        for d, t in docs:
            x = words(t)
            s = [tuple(x[j:j + k]) for j in range(len(x) - k + 1)]
            if not own & set(s):
                continue
            held = [(len(own & set(s[a:a + size + stride(size) - 1])) / len(own), a) for a in range(0, len(s), stride(size))]
            held = [h for h in held if h[0] >= least]
            if held:
                best = max(h[0] for h in held)
                out[d, i] = (name, best, min(a for c, a in held if c == best), len(held))
    return out


def result(df):
    return {(r.doc_id, r.notice): (r.license, r.containment, r.first_word, r.n_windows) for r in df.collect()}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = result(op7_license_scan(spark, sf))
    assert got == brute(docs) and len(got) > 10


def made():
    rng = random.Random(4)
    filler = lambda n: " ".join(f"w{rng.randint(0, 900)}" for _ in range(n))
    docs = [(0, None), (1, ""), (2, "All Rights RESERVED"), (3, "all rights"), (4, filler(3000))]
    for _, wording in NOTICES:
        for cut in (0, 1, 2, 3):
            w = wording.split()
            for _ in range(cut):
                w[rng.randrange(len(w))] = "changed"
            docs.append((len(docs), f"{filler(rng.randint(0, 200))} {' '.join(w)}\n{filler(rng.randint(0, 90))}"))
    docs.append((len(docs), " ".join(w for _, w in NOTICES) * 3))
    return docs


def test_whole_and_changed_notices(spark):
    docs = made()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, notice int, license string")
    assert result(scan(df)) == brute(docs)


def test_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([(None, "x All rights reserved"), (1, "all rights reserved"), (1, "all rights reserved")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.first_word) for r in scan(df).collect()) == [(0, 1), (1, 0)]
    assert scan(df.limit(0)).collect() == [] and scan(df, []).collect() == [] and scan(df, [("empty", "...")]).collect() == []


def test_sql_says_the_same(tmp_path, spark):
    duckdb = __import__("duckdb")
    docs = made()
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    rows = con.execute(scan_sql()).fetchall()
    assert {(r[0], r[2]): (r[1], r[3], r[4], r[5]) for r in rows} == brute(docs)


def test_bands_reach_the_stated_chance():
    assert bands(1, 0.8) == 1
    for size in (2, 4, 8, 32, 64):
        n, window = size // 2 + 1, size + stride(size) - 1
        similar = -(-0.8 * n // 1) / (n + window - -(-0.8 * n // 1))
        assert (1 - similar) ** bands(size, 0.8) <= 1e-4


def test_main_path_is_native(spark, sf):
    plan = op7_license_scan(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_notices_need_no_python_workers(spark, monkeypatch):
    """The notices reach the tasks as the engine's own rows: no table is made from the driver's Python."""
    docs = spark.createDataFrame([(1, "x All rights reserved"), (2, "nothing")], "doc_id long, text string")
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    assert [(r.doc_id, r.license, r.first_word) for r in scan(docs).collect()] == [(1, "all-rights-reserved", 1)]
    assert scan(docs, []).collect() == []
