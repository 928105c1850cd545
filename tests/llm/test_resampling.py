import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from herdflow.llm import resampling
from herdflow.llm.queries import op11_importance_resampling
from herdflow.llm.resampling import draw, ranked, resample, resample_sql, sorted_runs

M = 10_000


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


def plain(docs, target, n=1, percent=10, least=20, buckets=M):
    """Every document's row, by the words of the rule and one plain sort."""
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    def feats(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        f = [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]
        return [zlib.crc32(x.encode()) % buckets for x in f], len(w)

    own = [(d, *feats(t)) for d, t in docs]
    s, t = Counter(b for _, f, _ in own for b in f), Counter(b for x in target for b in feats(x)[0])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in s}
    out = []
    for d, f, words in own:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= least])
    may = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    k = percent * len(may) // 100
    rank = {id(r): i + 1 for i, r in enumerate(may[:k])}
    return sorted([(*r[:4], rank.get(id(r))) for r in out], key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_tables(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = rows(op11_importance_resampling(spark, sf))
    assert got == plain(docs, target)
    assert sum(r[4] is not None for r in got) == sum(r[1] >= 20 for r in got) // 10


ODD = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "é漢字 x\x00y Z_z`{9" * 9), (None, "a b " * 30), (None, "c d " * 30),
       (7, "a b " * 30), (7, "a b " * 30), (7, "q " * 30), (8, "w" * 50_000), (9, "a b c d e f g h i j " * 2)]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 0) for r in ODD], "doc_id long, text string, t int")
    df = df.withColumns({c: F.lit("x") for c in ["id", "score", "weight", "place", "segment", "rank", "features"]})
    target = spark.createDataFrame([("A b",), (None,)], "text string").withColumn("id", F.lit(1))
    for n in (1, 2):
        assert rows(resample(df, target, percent=60, n=n)) == plain(ODD, ["A b", None], n=n, percent=60)
    drawn = draw(df, target, percent=60)
    assert drawn.columns == df.columns
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in plain(ODD, ["A b", None], percent=60) if r[4]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(ODD, "doc_id long, text string")
    assert resample(none, some).collect() == []
    assert rows(resample(some, none, percent=100)) == plain(ODD, [], percent=100)


def test_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark(item_id BIGINT, text VARCHAR)")
    odd = [r for r in ODD if "\x00" not in (r[1] or "")]
    con.executemany("INSERT INTO documents VALUES (?, ?)", odd)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", [(1, "A b"), (2, "é漢字")])
    got = sorted(con.execute(resample_sql(percent=60)).fetchall(), key=str)
    df, target = spark.createDataFrame(odd, "doc_id long, text string"), spark.createDataFrame([("A b",), ("é漢字",)], "text string")
    assert got == rows(resample(df, target, percent=60))


def test_ranks_of_ties_and_hot_ids(spark):
    """Half the rows share score and id; ranks run on without a gap, and such rows are split between segments."""
    rng = random.Random(1)
    data = [(5, 30, 30, 0, 7) if i % 2 else (rng.randrange(50), 30, 30, 0, rng.randrange(20)) for i in range(4000)]
    df = spark.createDataFrame(data, "id long, n_words long, n_features long, weight long, score long").repartition(6)
    runs = sorted_runs(df)
    for k in (0, 1, 1500, 4000):
        got = ranked(runs, 4000, k).collect()
        want = sorted(((r[4], r[0]) for r in data), key=lambda x: (-x[0], x[1]))
        assert len(got) == 4000
        assert [(r.score, r.id) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == want[:k]
        assert sorted(r.rank for r in got if r.rank) == list(range(1, k + 1))
    cuts = resampling.splitters(runs, 4000, 8)
    sizes = [r["count"] for r in resampling.in_segments(runs, cuts).groupBy("segment").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_draw_follows_the_target(spark):
    """Documents with the target's words are drawn far more often."""
    rng = random.Random(2)
    docs = [(i, " ".join(("t%d" if i % 10 == 0 else "s%d") % rng.randrange(40) for _ in range(40))) for i in range(500)]
    target = spark.createDataFrame([(" ".join(f"t{j}" for j in range(40)),)], "text string")
    got = [r.doc_id for r in draw(spark.createDataFrame(docs, "doc_id long, text string"), target).collect()]
    assert sum(i % 10 == 0 for i in got) >= 45
