import random
import re
from collections import defaultdict

import numpy as np
import pytest

from herdflow.llm import near_dup
from herdflow.llm.components import components
from herdflow.llm.near_dup import near_duplicates
from herdflow.llm.queries import op6_near_dedup
from herdflow.llm.shingles import Sketcher, shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(docs, k, percent=80):
    """{doc_id: (n_shingles, component_id, kept)} from all pairs that share a shingle."""
    sets = {d: words_set(t, k) for d, t in docs}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    up = {d: d for d in sets}

    def find(d):
        while up[d] != d:
            up[d] = up[up[d]]
            d = up[d]
        return d

    for a, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for b in by[x]:
                if b > a:
                    common[b] += 1
        for b, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(op6_near_dedup(spark, sf)) == brute(docs, 4)


def made(n=120, seed=3):
    """A dense group around one text, drifting chains, short texts and odd texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 5000)}"
    base = [word() for _ in range(150)]
    docs = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(150)] = word()
        docs.append(" ".join(t))
    chain = [word() for _ in range(100)]
    for i in range(40):
        chain = chain[2:] + [word(), word()]
        docs.append(" ".join(chain))
    docs += ["one two", "One  TWO\n", "one two three", "É a b c d", "é a b c d", "same text here now", "same text here now", None, "", " \t\n",
             " ".join(word() for _ in range(400))]
    return list(enumerate(docs))


@pytest.mark.parametrize(("rows", "levels"), [(2048, None), (16, None), (8, ((4, 2), (8, 3), (24, 4)))])
def test_dense_groups_at_every_level(spark, monkeypatch, rows, levels):
    if levels:
        monkeypatch.setattr(near_dup, "LEVELS", levels)
    docs = made()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n long, cls string")
    assert result(near_duplicates(df, k=4, region_rows=rows)) == brute(docs, 4)


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (2, "other words in here now")],
                               "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_duplicates(df).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 2, True)]
    assert near_duplicates(df.limit(0)).collect() == []


def test_shingle_sets_by_plain_words():
    rng = random.Random(1)
    texts = ["", " ", "a", "A b", "  x\ty\nz  ", "日本 語 é É"] + [" ".join(rng.choice("abcdefg") for _ in range(n)) for n in range(1, 60)]
    for t in texts:
        for k in (1, 4, 5):
            assert len(shingle_set(t, k)) == len(words_set(t, k))
    assert shingle_set("A B\tc", 2).tolist() == shingle_set(" a  b c ", 2).tolist()
    assert shingle_set("a b", 2).tolist() != shingle_set("b a", 2).tolist()


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(2)
    s = np.sort(rng.integers(0, 1 << 62, 9000, dtype=np.uint64))
    sk = Sketcher()
    a, b = sk(s[:5000]), sk(s[1000:6000])
    assert abs((a == b).mean() - 4000 / 6000) < 0.1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_regions_of_equal_classes_are_searched_once(spark):
    """Trees that bring the same classes together are one region; every pair is still in one of a level."""
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join([*words[:190], *(f"x{i}-{j}" for j in range(i))])) for i in range(3)] + [(9, "a text of its own words")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    nodes = near_dup.shingled(df, 4, "doc_id", "text").select("cls", "doc", "sketch")
    by = defaultdict(set)
    for r in near_dup.regions(nodes, 10).collect():
        by[r.level, r.tree, r.region].add(r.cls)
    sets = [(k[0], frozenset(v)) for k, v in by.items()]
    of = {r.doc: r.cls for r in nodes.collect()}
    assert len(sets) == len(set(sets)) and any({of[0], of[1], of[2]} <= s for _, s in sets)


def test_linked_ids_are_one_component(spark):
    """Given links join documents of any texts, those without words join nothing, and no comparison is made for them."""
    body = " ".join(f"b{i}" for i in range(60))
    docs = [(1, "one text here with words"), (2, "another one of other words"), (3, body), (4, body + " more"), (5, None), (6, "the last of the texts")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    linked = spark.createDataFrame([(2, 1), (4, 2), (5, 6), (3, 4), (7, 6)], "a long, b long")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, 4, linked=linked).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6}
