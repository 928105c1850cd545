import math
import zlib

import numpy as np
import pytest

from herdflow.llm import toxicity
from herdflow.llm.queries import op4_toxicity


def test_held_out_quality_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = op4_toxicity(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(rows) == docs.count()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(label[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in label]
    hit = sum(y and p for y, p in held)
    assert hit / sum(y for y, _ in held) >= 0.8
    assert hit / sum(p for _, p in held) >= 0.9


@pytest.fixture(scope="module")
def made(spark):
    docs = [(i, ("gentle words about gardens " if i % 3 else "you absolute nastybad person ") * 3 + f"n{i}") for i in range(200)]
    labels = [(i, int(i % 3 == 0)) for i in range(150)] + [(3, 0), (3, 1), (4, None), (None, 1)]
    return (spark.createDataFrame([(*d, 0.5) for d in docs] + [(None, "x", 0.5), (900, None, 0.5), (901, "", 0.5), (902, "nastybad", 0.5)],
                                  "doc_id long, text string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_made_rows_and_odd_texts(made):
    docs, labels = made
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == docs.count()
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(200))
    assert got[900].score == got[901].score and got[None].held_out is False
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if not r.predicted}


def test_labels_of_held_out_rows_are_not_learned(spark, made):
    docs, labels = made
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) toxic")
    a, b = (toxicity.fit(docs, x) for x in (labels, flipped))
    assert a.bias == b.bias and (a.weight == b.weight).all()


def test_no_labels_one_label_and_empty_table(made):
    docs, labels = made
    for part, score in ((labels.limit(0), 0.0), (labels.filter("toxic = 0"), 0.0), (labels.filter("toxic = 1"), 1.0)):
        got = toxicity.score(docs, toxicity.fit(docs, part)).collect()
        assert all(abs(r.score - score) < 1e-6 for r in got)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).collect() == []


def test_features_by_hand():
    """Each n-gram inside a word once, whatever the part size."""
    f = toxicity.Features()
    def grams(text):
        s = "".join(c if c.isalnum() else " " for c in text.lower())
        return {" " + w + " " for w in s.split()}
    def plain(text):
        return {w[i:i + n] for w in grams(text) for n in toxicity.N_GRAMS for i in range(len(w) - n + 1)}
    a, b = f("Hello, world hello"), f("world hello")
    assert a.tolist() == b.tolist() and len(a) <= len(plain("hello world"))
    assert len(a) >= len(plain("hello world")) - 1
    assert len(f("")) == len(f(None)) == 0
    long = " ".join(f"word{i}" for i in range(3000))
    whole = f(long)
    before, toxicity.PART_CHARS = toxicity.PART_CHARS, 501
    try:
        assert np.array_equal(f(long), whole) or len(np.setdiff1d(whole, f(long))) == 0
    finally:
        toxicity.PART_CHARS = before


def test_fit_and_scores_by_a_plain_version():
    """Naive Bayes scales and the logistic fit, a row and a feature at a time over a dense table."""
    rng = np.random.default_rng(8)
    words = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot"]
    features = toxicity.Features()
    texts = [(" ".join(rng.choice(words[:4] if i % 3 else words[2:], 5)), int(i % 3 == 0), 1.0 + i % 2) for i in range(40)]
    rows = [(features(t), y, w) for t, y, w in texts]
    model = toxicity.fit_rows(rows, steps=15)
    names = sorted({f for ids, _, _ in rows for f in ids.tolist()})
    has = {i: set(ids.tolist()) for i, (ids, _, _) in enumerate(rows)}
    ones, zeros = sum(y for _, y, _ in rows), sum(1 - y for _, y, _ in rows)
    scale = {}
    for f in names:
        of = [sum(f in has[i] for i, r in enumerate(rows) if r[1] == y) for y in (0, 1)]
        if sum(of) > 2:
            scale[f] = math.log((of[1] + 1) / (ones + 2)) - math.log((of[0] + 1) / (zeros + 2))
    used = list(scale)
    whole = sum(w for _, _, w in rows)
    share = sum(w * y for _, y, w in rows) / whole
    theta = [0.0] * len(used) + [math.log(share / (1 - share))]
    m, v = [0.0] * len(theta), [0.0] * len(theta)
    for step in range(1, 16):
        g = [1e-3 * t for t in theta[:-1]] + [0.0]
        for i, (_, y, w) in enumerate(rows):
            z = theta[-1] + sum(theta[j] * scale[f] for j, f in enumerate(used) if f in has[i])
            err = w / whole * (1 / (1 + math.exp(-z)) - y)
            for j, f in enumerate(used):
                g[j] += err * scale[f] * (f in has[i])
            g[-1] += err
        for j, x in enumerate(g):
            m[j], v[j] = 0.9 * m[j] + 0.1 * x, 0.99 * v[j] + 0.01 * x * x
            theta[j] -= 0.05 * (m[j] / (1 - 0.9 ** step)) / (math.sqrt(v[j] / (1 - 0.99 ** step)) + 1e-8)
    assert model.bias == pytest.approx(theta[-1], abs=1e-9)
    for j, f in enumerate(used):
        assert model.weight[f] == pytest.approx(theta[j] * scale[f], abs=1e-9)
    scorer = toxicity.Scorer(model)
    for i, (t, _, _) in enumerate(texts):
        z = theta[-1] + sum(theta[j] * scale[f] for j, f in enumerate(used) if f in has[i])
        assert scorer(t) == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_sample_is_bounded_in_bytes(spark):
    """Rows are taken in the order of their hash as long as they fit, one of each label at least; reruns agree."""
    docs = spark.createDataFrame([(i, f"word{i} " * 3 + ("bad thing " if i % 2 else "good thing ") * 9) for i in range(120)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) toxic")
    whole, few, one = (toxicity.fit(docs, labels, sample_bytes=n) for n in (1 << 20, 2000, 1))
    assert few.bias != whole.bias and np.isfinite(one.bias)
    again = toxicity.fit(docs.repartition(7), labels.repartition(3), sample_bytes=2000)
    assert again.bias == few.bias and (again.weight == few.weight).all()
