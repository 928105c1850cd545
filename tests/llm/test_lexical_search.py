import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from herdflow.llm import lexical_search
from herdflow.llm.lexical_search import Items, Search, search, search_sql
from herdflow.llm.queries import op13_lexical_search


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


def terms(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k=10):
    """All scores of all pairs that share a term."""
    own = [(d, Counter(terms(t))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for i, text in items:
        score = defaultdict(int)
        for t, r in Counter(terms(text)).items():
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) if t in df else 0
            for x, (_, c) in enumerate(own):
                if t in c:
                    m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
                    score[x] += r * w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
        found = sorted(((-s, own[x][0] is None, own[x][0] or 0, own[x][0]) for x, s in score.items() if s > 0))[:k]
        out += [(i, rank + 1, f[3], -f[0]) for rank, f in enumerate(found)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_tables(spark, sf):
    read = lambda n, i: [tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(i, "text").collect()]
    docs, items = read("documents", "doc_id"), read("benchmark", "item_id")
    got = op13_lexical_search(spark, sf)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == plain(docs, items)


ODD = [(1, None), (2, ""), (3, " ,\n"), (4, "One two"), (5, "é漢字 x\x00y Z_z`{9 two"), (None, "a b two"), (None, "c d two a"),
       (7, "a b"), (7, "a b"), (7, "q a"), (8, "w" * 50_000 + " a"), (9, "a b c d e f g h i j " * 2000), (10, "A.b-C")]
ASK = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "two é漢字 z"), (4, "absent"), (5, "a a a A w"), (6, " ".join("abcdefghij"))]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 0) for r in ODD], "doc_id long, text string, x int")
    docs = docs.withColumns({c: F.lit("x") for c in ["id", "n", "terms", "tf", "item", "score", "rank", "item_id"]})
    items = spark.createDataFrame([(*r, 0) for r in ASK], "item_id long, text string, doc_id int")
    for k in (1, 3, 20):
        assert rows(search(docs, items, k)) == plain(ODD, ASK, k)
    assert rows(search(docs, items, 3, block_cells=1)) == plain(ODD, ASK, 3)     # a block an item


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(ODD, "doc_id long, text string"), spark.createDataFrame(ASK, "item_id long, text string")
    assert search(docs.limit(0), items).collect() == [] == search(docs, items.limit(0)).collect()
    assert search(docs, items.limit(0)).schema.simpleString() == search(docs, items).schema.simpleString()


def test_hot_copies_and_ties(spark):
    """A third of all rows are copies; equal scores go by id, over many partitions."""
    rng = random.Random(4)
    docs = [(i, "the same copied text") if i % 3 == 0 else (i, " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(9))))
            for i in rng.sample(range(5000), 3000)]
    items = [(i, t) for i, t in enumerate(["same text", "aa bb", "hh", "copied aa aa cc", "the"] + ["dd ee %d" % i for i in range(30)])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows(search(df, spark.createDataFrame(items, "item_id long, text string"), 10)) == plain(docs, items)


def test_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark(item_id BIGINT, text VARCHAR)")
    odd = [r for r in ODD if "\x00" not in (r[1] or "")]
    con.executemany("INSERT INTO documents VALUES (?, ?)", odd)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", ASK)
    docs, items = spark.createDataFrame(odd, "doc_id long, text string"), spark.createDataFrame(ASK, "item_id long, text string")
    assert sorted(con.execute(search_sql(3)).fetchall(), key=str) == rows(search(docs, items, 3))


def test_bounds_drop_most_leaves():
    """With the floors of a good probe, most leaves are never scored, and nothing is lost."""
    rng = np.random.default_rng(3)
    n, v = 8000, 400
    topic = np.sort(rng.integers(0, 40, n))
    ts = [np.unique(np.concatenate((rng.integers(0, 10, 3), 10 * t + rng.integers(0, 10, 4) if t else [], rng.integers(0, v, 1)))).astype(int)
          for t in topic]
    rb = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.full(n, 8)), pa.array(ts, pa.list_(pa.int32())),
                                     pa.array([[1] * len(t) for t in ts], pa.list_(pa.int32()))], names=["id", "n", "terms", "tf"])
    items = Items(list(range(40)), {str(i).encode(): i for i in range(v)},
                  [Counter({10 * t + j: 1 for j in range(6)} | {t % 10: 1}) for t in range(40)])
    items.weigh(np.where(np.arange(v) < 10, 100, 5000))
    probe = Search(items, 10, None, n, 8 * n)
    probe.probe(rb)
    floors = np.zeros(40, np.int64)
    for p, heap in enumerate(probe.best):
        floors[items.order[p]] = heap[0][0] if len(heap) == 10 else 0
    full, scored = Search(items, 10, floors, n, 8 * n), []
    real = full.score
    full.score = lambda b, lo, hi, places, cols: (scored.append(len(places)), real(b, lo, hi, places, cols))
    full.search(rb)
    assert sum(scored) < 0.2 * 40 * (n / lexical_search.LEAF)
    dense = np.zeros((n, v), np.int64)
    for d, t in enumerate(ts):
        dense[d, t] = lexical_search.saturated(np.ones(1, int), np.full(1, 8), n, 8 * n)[0]
    want = items.vectors.astype(np.int64) @ dense.T
    for p, heap in enumerate(full.best):
        order = np.lexsort((np.arange(n), -want[p]))[:10]
        assert sorted(((s, -d) for s, d, _ in heap), key=lambda r: (-r[0], r[1])) == [(want[p][d], d) for d in order]
