import hashlib
from collections import defaultdict

import numpy as np
import pytest

from herdflow.llm.line_dedup import dedup_lines, keep_bitmap, kept_lines, kept_text, line_report
from herdflow.llm.queries import op8_line_dedup


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_chars=10):
    """doc_id, text pairs to (doc_id, n_lines, n_dropped, kept text)."""
    last = (1 << 63) - 1
    holders = defaultdict(set)
    key = lambda x: x.strip(SPACE).translate(LOWER)
    for d, t in docs:
        for x in (t or "").split("\n"):
            holders[key(x)].add(last if d is None else d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or min(holders[key(x)]) == (last if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same(rows, docs):
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain(docs)]
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows], key=order) == sorted(want, key=order)


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    same(op8_line_dedup(spark, sf).collect(), docs)
    texts = dict(docs)
    for r in line_report(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        assert hashlib.sha256(kept_text(texts[r.doc_id], r.keep_bitmap).encode()).hexdigest() == r.kept_sha256


HARD = [
    (1, "Common line of all\nshort\nonly in one document"), (2, " common LINE of all\t\nshort\n"), (3, None), (4, ""),
    (5, "common line of all"), (6, "x common line of all"), (7, "ÀÉÎ common line\nàéî common line"),
    (8, "ÀÉÎ COMMON LINE"), (None, "common line of all\nunder no id at all"), (9, "\n\n\n"), (10, "tenletters\ntenletters"),
    (11, "TENLETTERS\nninechars"), (12, "ninechars"), (13, "windows line end here\r\nwindows line end here"),
    (14, "windows line end here"), (15, "日本語の行は十文字以上あります"), (16, "日本語の行は十文字以上あります\n日本語"),
]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_hard_cases(spark, parts):
    docs = HARD + [(100 + i, f"hot line of everyone\nown line number {i}\nhot line of everyone") for i in range(300)]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, pos int, keep int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(line_report(df).collect(), docs)
        kept = {(r.doc_id, r.text) for r in dedup_lines(df).collect()}
        assert kept == {(d, t if t is not None or k else None) for (d, _, k, t), (_, o) in zip(plain(docs), docs, strict=True)
                        if o is not None} | {(3, None)}
        assert dedup_lines(df).columns == df.columns
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_and_empty(spark):
    docs = [(1, "a line that repeats"), (1, "a line that repeats"), (1, "another text\na line that repeats"),
            (2, "a line that repeats"), (2, "a line that repeats")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    same(line_report(df).collect(), docs)
    assert line_report(df.limit(0)).collect() == []


def test_bitmap_round_trip():
    for n, drop in ((1, []), (9, [0, 8]), (1000, list(range(0, 1000, 3)))):
        keep = kept_lines(n, keep_bitmap(n, np.array(drop, int)))
        assert np.flatnonzero(~keep).tolist() == drop and len(keep) == n
