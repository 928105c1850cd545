import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from herdflow.llm.packing import Counts, best_fit, pack, piece_starts, pieces, plan, reduce_by_dominance
from herdflow.llm.queries import BYTE_BPE_RANKS, BYTE_BPE_SPECIAL, op2_best_fit_packing


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


RANKS = public_tokenizers.path(BYTE_BPE_RANKS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, library, capacity):
    """Pieces cover each document's ids; sequences are gapless and within capacity."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for d, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(ids)
    for items in by_seq.values():
        at = 0
        for off, n in sorted(items):
            assert off == at
            at += n
        assert at <= capacity
    return len(by_seq)


def test_whole_table(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_best_fit_packing(spark, sf).collect()
    n = check(rows, texts, library, 2048)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 2048) + 1


def test_small_capacity_nulls_repeats_and_hot_length(spark, library):
    texts = {i: "same words here" for i in range(500)} | {1000: None, 1001: "", 1002: "a b c " * 50, 1003: "x<|endoftext|>y"}
    df = spark.createDataFrame([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, length int")
    rows = pack(pieces(df, RANKS, BYTE_BPE_SPECIAL, capacity=16), capacity=16).collect()
    check(rows, texts, library, 16)
    two = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id long, text string")
    got = pack(pieces(two, RANKS, BYTE_BPE_SPECIAL, capacity=9), capacity=9).collect()
    assert sorted(r.offset for r in got) == [0, 3, 6] and len({r.sequence_id for r in got}) == 1
    assert pack(pieces(two.limit(0), RANKS, BYTE_BPE_SPECIAL)).collect() == []


def test_long_white_space(spark, library):
    n = 2_000_000
    texts = {1: " " * n, 2: "a" + "\n" * n + "b <|endoftext|> c", 3: "a" + " \n" * (n // 2), 4: "x" + "\u3000" * n, 5: "x" + " " * 99_999 + "y"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pack(pieces(df, RANKS, BYTE_BPE_SPECIAL)).collect(), texts, library, 2048)


def test_piece_starts():
    assert piece_starts(5, 4) == [(0, 1), (1, 4)]
    assert piece_starts(8, 4) == [(0, 4), (4, 4)]
    assert piece_starts(1, 4) == [(0, 1)]


def fewest(items, capacity):
    """Fewest bins by trying all ways."""
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i] and rooms[k] not in rooms[:k]:
                go(i + 1, [*rooms[:k], rooms[k] - items[i], *rooms[k + 1:]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimum(seed):
    rng = random.Random(seed)
    c = rng.choice([10, 17, 30])
    items = sorted((rng.randint(1, c) for _ in range(rng.randint(1, 9))), reverse=True)
    counts = Counts({x: items.count(x) for x in items})
    fixed = reduce_by_dominance(counts, c)
    rest = sorted((s for s, n in counts.n.items() for _ in range(n)), reverse=True)
    assert sum(g.bins for g in fixed) + fewest(rest, c) == fewest(items, c)
    used = sorted([s for g in fixed for s, k in g.items for _ in range(k * g.bins)] + rest, reverse=True)
    assert used == items
    assert all(g.room(c) >= 0 for g in fixed + best_fit(counts, c))


@pytest.mark.parametrize(("items", "c"), [([11, 8, 4, 4, 4, 3, 3, 3], 20), ([11, 8, 4, 4, 4, 3, 3, 3, 20, 19], 20), ([9, 5, 5, 2, 2, 2, 1, 1], 14)])
def test_reduction_leaves_pieces_beside_which_three_fit(items, c):
    counts = Counts({x: items.count(x) for x in items})
    fixed = reduce_by_dominance(counts, c)
    rest = sorted((s for s, n in counts.n.items() for _ in range(n)), reverse=True)
    assert sum(g.bins for g in fixed) + fewest(rest, c) == fewest(sorted(items, reverse=True), c)


def plain_best_fit(items, c):
    rooms = []
    for x in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(c - x)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_class_wise_best_fit_equals_piece_wise(seed):
    rng = random.Random(seed)
    c = rng.choice([20, 64])
    items = [rng.choice([rng.randint(1, c), 7, 3]) for _ in range(200)]
    got = best_fit(Counts({x: items.count(x) for x in set(items)}), c)
    assert sorted(r for g in got for r in [g.room(c)] * g.bins) == plain_best_fit(items, c)
    assert sum(g.bins for g in plan({x: items.count(x) for x in set(items)}, c)) <= len(plain_best_fit(items, c))
