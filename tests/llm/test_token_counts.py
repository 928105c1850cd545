import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from herdflow.llm.bpe import RankTable, count_symbols
from herdflow.llm.queries import op1_token_counts
from herdflow.llm.token_counts import Counter, token_counts


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def n_tokens(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_whole_table_equals_the_library(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_token_counts(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = n_tokens(library, texts[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 512)


CASES = [
    None, "", " ", "\n\n", "a", "aaa", "aaaaaaa" * 50, "it's we'll  THEY'RE", "x<|endoftext|>y<|endoftext|>",
    "<|endoftext|>", "<|endoftext", "tab\t\x0b\x1c\x85  end ", "日本語のテキスト 123４５६", "🙂👩‍👩‍👧 é é",
    "՘a՘ ࢏౜b", "\U00010940x", "٣٤ ½ ²", "\x00\x01", "ab" * 3000, "=" * 5000, "zqxj" * 2000,
]


def test_odd_texts(spark, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, PATH).collect()}
    assert got == {i: n_tokens(library, t) for i, t in enumerate(CASES)}


def test_null_ids_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in token_counts(df, PATH).collect()) == [(0, 2), (1, 2), (1, 2)]
    assert token_counts(df.filter(F.lit(False)), PATH).collect() == []


def test_merge_order_is_by_rank():
    t = RankTable(PATH)
    assert count_symbols(t, [b"a", b"the", b" the"]).tolist() == [1, 1, 1]
    assert count_symbols(t, []).tolist() == []


def test_memo_overflow_changes_nothing(monkeypatch):
    import herdflow.llm.token_counts as m
    texts = [f"word{i} other{i * 7} " * 5 for i in range(300)]
    a = Counter(PATH).counts(texts)
    monkeypatch.setattr(m, "MEMO", 10)
    monkeypatch.setattr(m, "CHUNK_CHARS", 200)
    assert Counter(PATH).counts(texts) == a
