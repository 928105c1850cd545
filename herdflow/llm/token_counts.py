"""Token counts of whole texts by a byte-level BPE vocabulary, without the tokeniser library.

Each task splits its texts into pre-tokens, merges the ones it has not met yet rank by rank
(see ``bpe``) and adds up the symbols that survive. There is no shuffle; memory is bounded by
`CHUNK_CHARS` of text (or one text, if longer) and a memo of at most `MEMO` pre-tokens, which
is emptied when full and changes no result.

Cases: a null or empty text has 0 tokens and 0 bytes; a null id passes through; repeated rows
are counted each by itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from herdflow.llm.bpe import RankTable, count_symbols

CHUNK_CHARS = 1 << 20
MEMO = 300_000
#: Longer pre-tokens (runs without a break) are merged, but not kept in the memo.
MEMO_CHARS = 64


class Counter:
    """Counts the tokens of texts, with a bounded memo of pre-tokens."""

    def __init__(self, path: str):
        self.table = RankTable(path)
        self.memo: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text and the number of special strings in it."""
        special = self.table.special
        if special is None or not special.search(text):
            return self.table.pre_tokens(text), 0
        parts = special.split(text)
        return [p for part in parts for p in self.table.pre_tokens(part)], len(parts) - 1

    def chunk(self, texts: list[str]) -> list[int]:
        split = [self.pieces(t) if t else ([], 0) for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list(set().union(*(p for p, _ in split)).difference(self.memo))
        found = dict(zip(new, count_symbols(self.table, [p.encode() for p in new]).tolist(), strict=True))
        self.memo.update((k, v) for k, v in found.items() if len(k) <= MEMO_CHARS)
        long = {k: v for k, v in found.items() if len(k) > MEMO_CHARS}
        memo, out = self.memo, []
        for p, extra in split:
            if long:
                out.append(extra + sum(memo[x] if len(x) <= MEMO_CHARS else long[x] for x in p))
            else:
                out.append(extra + sum(map(memo.__getitem__, p)))
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; texts are handled `CHUNK_CHARS` at a time."""
        out: list[int] = []
        chunk: list[str] = []
        size = 0
        for t in texts:
            chunk.append(t or "")
            size += len(t or "")
            if size >= CHUNK_CHARS:
                out += self.chunk(chunk)
                chunk, size = [], 0
        return out + self.chunk(chunk)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per row of `docs`: the id, n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for b in batches:
            n = pa.array(counter.counts(b.column(1).to_pylist()), pa.int64())
            size = pc.fill_null(pc.cast(pc.binary_length(b.column(1)), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), size, n, pc.greater(n, limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
