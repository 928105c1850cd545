import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.llm.mixing import draw, fill, mix_report, plan_mix, split_quotas
from herdflow.llm.queries import op9_mix_sources


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Targets by sharing the excess again and again, a step at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    t = {s: total * w[s] / sum(w.values()) for s in names}
    while True:
        excess = sum(max(0, t[s] - 2 * sizes[s]) for s in names)
        if excess < 1e-6 * max(total, 1):
            return t
        free = [s for s in names if t[s] < 2 * sizes[s]]
        t = {s: min(t[s], 2 * sizes[s]) for s in names}
        for s in free:
            t[s] += excess * w[s] / sum(w[x] for x in free)


def check(rows, docs):
    size = {d: len(WORD.findall(t or "")) for d, t, _ in docs}
    total, taken = defaultdict(int), defaultdict(int)
    of = {d: s for d, _, s in docs}
    for d, s in of.items():
        total[s] += size[d]
    target = plain_targets(total)
    assert sorted(r.doc_id for r in rows) == sorted(of)
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == total[of[r.doc_id]]
        assert r.target == pytest.approx(target[of[r.doc_id]], rel=1e-4, abs=1e-6)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[of[r.doc_id]] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= max([size[d] for d in of if of[d] == s]) / 2 + 1


def test_whole_table_and_rerun(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op9_mix_sources(spark, sf).collect()
    check(rows, docs)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op9_mix_sources(spark, sf).collect()))


def test_odd_sources(spark):
    docs = [(i, "w " * (i % 7), ["a", "b", None, "é", "Z", "empty"][i % 6]) for i in range(600)]
    docs = [(d, None if s == "empty" else t, s) for d, t, s in docs]
    df = spark.createDataFrame([(d, t, s, 1) for d, t, s in docs], "doc_id long, text string, source string, size int")
    mix = plan_mix(df, shards=7)
    rep = mix_report(mix).withColumnRenamed("id", "doc_id").collect()
    check(rep, docs)
    out = draw(df, mix).collect()
    copies = defaultdict(list)
    for r in out:
        copies[r.row.doc_id].append(r.shard)
    assert {d: sorted(v) for d, v in copies.items()} == {r.doc_id: sorted(r.shards) for r in rep if r.copies}
    assert all(0 <= x < 7 for v in copies.values() for x in v)


def test_repeated_rows_one_source_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", "s")] * 4 + [(2, "c", "s")], "doc_id long, text string, source string")
    rows = mix_report(plan_mix(df)).collect()
    assert len(rows) == 5 and abs(sum(r.taken for r in rows) - 13.5) <= 2       # 150% of 9 words
    assert plan_mix(df.limit(0)) is None


@pytest.mark.parametrize("repeats", ["texts", "rows"])
def test_shared_and_null_ids_meet_their_targets(spark, repeats):
    """Most rows of one source share an id, all of another have none; each row is drawn by itself."""
    text = lambda i: "w " * (i % 9 + 1) if repeats == "rows" else f"t{i} " + "w " * (i % 9)
    docs = [(7 if i % 5 < 3 else i, text(i), "a") for i in range(3000)] + [(i, text(i), "b") for i in range(400)]
    docs += [(None, text(i), "c") for i in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    df = df.withColumns({c: F.lit("x") for c in ["__h", "__block", "__shard", "row", "id", "th", "nth", "h", "shard", "order", "size"]})
    mix = plan_mix(df)
    rows = mix_report(mix).collect()
    assert len(rows) == len(docs)
    target, taken, size = {r.source: r.target for r in rows}, defaultdict(int), defaultdict(int)
    for r in rows:
        taken[r.source] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    for s in "abc":
        assert abs(taken[s] - target[s]) <= 9
    out = draw(df, mix)
    assert out.schema["row"].dataType == T.StructType(df.schema.fields) or [f.name for f in out.schema["row"].dataType.fields] == df.columns
    for r in out.collect():
        size[r.row.source] += len(WORD.findall(r.row.text))
    assert size == taken
    assert sorted((str(r.id), str(r.source), r.size, r.taken) for r in rows) == sorted(
        (str(r.id), str(r.source), r.size, r.taken) for r in mix_report(plan_mix(df.repartition(3))).collect())


def test_tree_keeps_exact_quotas():
    q = np.array([100, 0, 7, 33])
    out = split_quotas(q, 5, 3)
    assert (out.sum(axis=0) == q).all() and out.min() >= 0
    assert out.sum(axis=1).tolist() == pytest.approx([28] * 5, abs=1)
    assert (out == split_quotas(q, 5, 3)).all()


def test_fill_stops_at_the_cap():
    assert fill([10, 1000], [5, 2], 1000, 2.0) == [20.0, 980.0]
    assert fill([0, 0], [5, 2], 0, 2.0) == [0.0, 0.0]
