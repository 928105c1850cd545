"""Exact line dedup over the whole corpus, returned as compressed keep bitmaps.

A line's key is the line stripped of ASCII white space, with A-Z in lower case. Keys of at least
`min_chars` code points that two documents hold lose all their lines except in the document with
the smallest id.

1. Lines become rows of hashes: 128 bits of the key, the document, the position. No text moves.
2. The rows are range-partitioned and sorted by (key, document, position), so a common line is
   spread over as many partitions as its rows fill.
3. Each partition is read as a stream; a key's first row names its first document, and rows of
   other documents are dropped. Only a partition's first key may have begun earlier: its rows are
   settled by a table of the first and last key of every partition (two rows per partition).
4. The dropped positions of each document become a zlib-compressed bitmap of the lines it keeps.

Cases: a null or empty text is one empty line; a null id is one document after all others; rows
that share an id are one document with a bitmap for each of its texts; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.llm.common import staged

#: ASCII white space, and the letters that are folded (fixed values).
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SETTLED, OPEN, EDGE = 0, 1, 2


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """A row per line whose key is long enough: h1, h2, doc, text_hash, pos, n_lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.col(id_col).cast("long").alias("doc"), text_hash(F.col(text_col)).alias("th"),
                        F.split(text, "\n", -1).alias("lines"))
    rows = lines.select("doc", "th", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    rows = rows.withColumn("key", F.translate(F.btrim("line", F.lit(SPACE)), UPPER, LOWER))
    return (rows.filter(F.length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
                    F.coalesce("doc", F.lit((1 << 63) - 1)).alias("doc"), "th", "pos", "n_lines"))


STREAM = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("h1", T.LongType()),
                       T.StructField("h2", T.LongType()), T.StructField("doc", T.LongType()),
                       T.StructField("th", T.LongType()), T.StructField("pos", T.IntegerType()),
                       T.StructField("n_lines", T.IntegerType())])


def stream_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one partition to the rows it drops, its first key's rows, and its edges."""
    last = None          # key and first document of the key being read
    first_key = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        h1, h2, doc, th, pos, n_lines = (b.column(i).to_numpy() for i in range(6))
        new = np.ones(n, bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is not None:
            new[0] = (h1[0], h2[0]) != last[:2]
        starts = np.flatnonzero(new)
        group = np.cumsum(new)           # 0: still the key of the batch before
        firsts = np.concatenate(([last[2] if last is not None else 0], doc[starts]))
        kind = np.where(doc != firsts[group], SETTLED, -1)
        if first_key is None:
            first_key = (h1[0], h2[0])
            yield _edge(h1[0], h2[0], doc[0])
        open_ = (h1 == first_key[0]) & (h2 == first_key[1])
        kind[open_] = OPEN
        out = kind >= 0
        if out.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[out], pa.int32()), *(pa.array(c[out], pa.int64()) for c in (h1, h2, doc, th)),
                 pa.array(pos[out], pa.int32()), pa.array(n_lines[out], pa.int32())], names=STREAM.names)
        last = (h1[-1], h2[-1], firsts[group[-1]])
    if last is not None:
        yield _edge(*last)


def _edge(h1: int, h2: int, doc: int) -> pa.RecordBatch:
    row = (EDGE, h1, h2, doc, 0, 0, 0)
    kinds = (pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=STREAM.names)


def keep_bitmap(n_lines: int, dropped: np.ndarray) -> bytes:
    """Compressed bits, one per line, 1 where the line stays."""
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def kept_lines(n_lines: int, bitmap: bytes) -> np.ndarray:
    """The bitmap as booleans."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


BITMAP = T.StructType([T.StructField("doc", T.LongType()), T.StructField("th", T.LongType()),
                       T.StructField("n_lines", T.IntegerType()), T.StructField("n_dropped", T.IntegerType()),
                       T.StructField("keep", T.BinaryType())])


def keep_bitmaps(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document text that loses lines: doc, th (hash of the text), n_lines, n_dropped, keep."""
    rows = staged(line_rows(docs, id_col, text_col, min_chars), "line-rows")
    order = ["h1", "h2", "doc", "th", "pos"]
    stream = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(stream_firsts, STREAM),
                    "line-stream")
    edges = stream.filter(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.min("doc").alias("first_doc"))
    late = (stream.filter(F.col("kind") == OPEN).join(F.broadcast(edges), ["h1", "h2"])  # two edges a partition
            .filter(F.col("doc") != F.col("first_doc")))
    dropped = stream.filter(F.col("kind") == SETTLED).select("doc", "th", "n_lines", "pos").unionAll(
        late.select("doc", "th", "n_lines", "pos"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_pylist()
            drops = [np.unique(p.values.to_numpy()) for p in b.column(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([len(d) for d in drops], pa.int32()),
                 pa.array([keep_bitmap(k, d) for k, d in zip(n, drops, strict=True)], pa.binary())], names=BITMAP.names)

    return dropped.groupBy("doc", "th", "n_lines").agg(F.collect_list("pos").alias("pos")).mapInArrow(pack, BITMAP)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the columns __n_dropped and __keep (null where every line stays)."""
    b = bitmaps.select(F.col("doc").alias("__doc"), F.col("th").alias("__th"), F.col("n_dropped").alias("__n_dropped"),
                       F.col("keep").alias("__keep"))
    own = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    return docs.join(b, (own == F.col("__doc")) & (text_hash(F.col(text_col)) == F.col("__th")), "left").drop("__doc", "__th")


def kept_text(text: str | None, bitmap: bytes | None) -> str:
    """The text without the lines its bitmap drops."""
    if bitmap is None:
        return text or ""
    lines = (text or "").split("\n")
    return "\n".join(x for x, k in zip(lines, kept_lines(len(lines), bitmap), strict=True) if k)


def line_report(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_lines, n_dropped, the SHA-256 of the kept text and the keep bitmap."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                           T.StructField("keep_bitmap", T.BinaryType())])
    joined = with_bitmaps(docs.select(id_col, text_col), keep_bitmaps(docs, min_chars, id_col, text_col), id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, sha = [], []
            for t, k in zip(b.column(1), b.column(3), strict=True):
                t = t.as_py() or ""
                lines.append(t.count("\n") + 1)
                sha.append(hashlib.sha256(kept_text(t, k.as_py()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lines, pa.int64()), b.column(2).cast(pa.int64()).fill_null(0),
                 pa.array(sha), b.column(3)], names=schema.names)

    return joined.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with each text cut to its kept lines; other columns stay (null texts that lose nothing stay null)."""
    joined = with_bitmaps(docs, keep_bitmaps(docs, min_chars, id_col, text_col), id_col, text_col)

    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = dict(zip(b.schema.names, b.columns, strict=True))
            cols[text_col] = pa.array([t.as_py() if k.as_py() is None else kept_text(t.as_py(), k.as_py())
                                       for t, k in zip(cols[text_col], cols["__keep"], strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)

    return joined.drop("__n_dropped").mapInArrow(run, docs.schema)
