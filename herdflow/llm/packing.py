"""Best-fit packing of token pieces into sequences, after a dominance reduction.

Only the lengths matter for which pieces share a sequence, and there are at most `capacity`
of them. So the plan is made from the histogram of lengths (at most `capacity` rows, whatever
the corpus), and the rows are then dealt to the plan's places by their rank within a length:

1. `pieces`: each document's ids (end id included) cut into pieces; one row per piece.
2. `plan`: on the histogram, the Martello-Toth reduction permanently fixes small sets that
   dominate every other set with the same largest piece, as long as one is found:
   a piece with no partner stands alone; a piece and its exact complement; a piece with its
   largest partner, when no two pieces fit beside it, or when no three do and that partner is as
   large as the best pair that fits. The rest is packed best-fit in decreasing order, a whole length class
   at a time.
3. `assign`: every piece gets its rank within its length. A length may hold a third of all rows,
   so ranks are counted within (length, bucket) and shifted by the buckets' running totals.

Cases: a null or empty text is the end id alone; rows with a repeated or null id are packed like
any other (ranks then follow the hash of the ids); an empty table gives an empty result; texts with
a white-space run of `LONG_SPACE` or more go to the `tokenizers` file beside the ranks file, since
`tiktoken` fails on runs of about a million.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.llm.common import staged

#: Rows of one (length, bucket) group that rank together, about.
BUCKET_ROWS = 100
MAX_BUCKETS = 4096
#: White-space characters in a row that `tiktoken` is not given (it fails between 900,000 and 1,100,000).
LONG_SPACE = 100_000


# ---------------------------------------------------------------- pieces

def encoder(ranks_path: str, special: dict[str, int]):
    """Text to ids, from a ranks file; `special` strings inside a text get their ids.

    The same vocabulary stands beside the ranks file as a `tokenizers` file (.json).
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    long_space = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}")
    whole = None

    def encode(text: str) -> list[int]:
        nonlocal whole
        if len(text) < LONG_SPACE or not long_space.search(text):
            return enc.encode(text, allowed_special="all")
        if whole is None:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(os.path.splitext(ranks_path)[0] + ".json")
        return whole.encode(text, add_special_tokens=False).ids

    return encode


def piece_starts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole pieces at its end, the rest first."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, ranks_path: str, special: dict[str, int], capacity: int = 2048, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, special)
        for b in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                text = text.as_py()
                ids = np.array([*(encode(text) if text else ()), end_id], "<u4")
                for k, (s, n) in enumerate(piece_starts(len(ids), capacity)):
                    at.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s:s + n].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


# ---------------------------------------------------------------- plan

@dataclass
class Group:
    """`bins` sequences with the same contents: (length, copies) in order."""

    items: list[tuple[int, int]]
    bins: int

    def room(self, capacity: int) -> int:
        return capacity - sum(n * k for n, k in self.items)


class Counts:
    """How many pieces of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, k: int) -> None:
        self.n[size] -= k
        if not self.n[size]:
            del self.n[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def largest(self, most: int, without: int | None = None) -> int | None:
        """The largest length of at most `most`; one piece of length `without` is in use."""
        i = bisect_right(self.sizes, most) - 1
        while i >= 0 and self.sizes[i] == without and self.n[without] < 2:
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def smallest(self, k: int, used: int) -> int | None:
        """The sum of the `k` smallest pieces beside one of length `used`."""
        out: list[int] = []
        for s in self.sizes[:k + 1]:
            out += [s] * min(k, self.n[s] - (s == used))
        return sum(out[:k]) if len(out) >= k else None

    def best_pair(self, most: int, used: int) -> int:
        """The largest sum of two pieces of at most `most`, beside one of length `used` (0: none)."""
        best, i, j = 0, 0, bisect_right(self.sizes, most) - 1
        left = lambda s: self.n[s] - (s == used)
        while i <= j and j >= 0:
            a, b = self.sizes[i], self.sizes[j]
            if not left(a):
                i += 1
            elif not left(b) or a + b > most:
                j -= 1
            elif i == j:
                if left(a) > 1:
                    best = max(best, a + b)
                break
            else:
                best = max(best, a + b)
                if left(a) > 1 and 2 * a <= most:
                    best = max(best, 2 * a)
                i += 1
        return best


def reduce_by_dominance(left: Counts, capacity: int) -> list[Group]:
    """Fix the sets that dominate all others with the same largest piece; `left` keeps the rest."""
    fixed: list[Group] = []
    found = True
    while found:
        found = False
        for size in sorted(left.sizes, reverse=True):
            while left.n.get(size):
                room = capacity - size
                mate = left.largest(room, without=size)
                if mate is None:             # nothing fits beside it
                    k = left.n[size] if 2 * size > capacity else 1
                    fixed.append(Group([(size, 1)], k))
                    left.take(size, k)
                    found = True
                    continue
                two, three = left.smallest(2, size), left.smallest(3, size)
                if (mate == room or two is None or two > room
                        or (three is None or three > room) and mate >= left.best_pair(room, size)):
                    if mate == size:
                        k = left.n[size] // 2
                        fixed.append(Group([(size, 2)], k))
                        left.take(size, 2 * k)
                    else:
                        # the condition stays true while either length lasts
                        k = min(left.n[size], left.n[mate])
                        fixed.append(Group([(size, 1), (mate, 1)], k))
                        left.take(size, k)
                        left.take(mate, k)
                    found = True
                    continue
                break
    return fixed


def best_fit(left: Counts, capacity: int) -> list[Group]:
    """Best-fit decreasing of what is left, a length class at a time."""
    rooms: list[int] = []
    open_: dict[int, list[Group]] = {}
    full: list[Group] = []

    def put(g: Group) -> None:
        room = g.room(capacity)
        if not room:
            full.append(g)
        else:
            if room not in open_:
                insort(rooms, room)
            open_.setdefault(room, []).append(g)

    for size in sorted(left.sizes, reverse=True):
        n = left.n[size]
        while n:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                g = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                g = Group([], n)
                room = capacity
            each = room // size
            bins = min(g.bins, n // each)
            if bins:                         # these sequences take as many as fit
                put(Group([*g.items, (size, each)], bins))
                n -= bins * each
            rest = g.bins - bins
            if rest and n and n < each:      # one sequence takes the last pieces
                put(Group([*g.items, (size, n)], 1))
                rest -= 1
                n = 0
            if rest and g.items:
                put(Group(g.items, rest))
    return full + [g for gs in open_.values() for g in gs]


def plan(histogram: dict[int, int], capacity: int) -> list[Group]:
    """All sequences as groups of equal contents."""
    left = Counts(histogram)
    return reduce_by_dominance(left, capacity) + best_fit(left, capacity)


def places(groups: list[Group]) -> dict[str, np.ndarray]:
    """For each length the runs of ranks and where they go, as arrays sorted by (length, rank)."""
    rank: dict[int, int] = {}
    rows = []
    first = 0
    for g in groups:
        at = 0
        for size, each in g.items:
            low = rank.get(size, 0)
            rows.append((size, low, each, first, at))
            rank[size] = low + each * g.bins
            at += size * each
        first += g.bins
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("size", "low", "each", "first", "at"), cols, strict=True))


# ---------------------------------------------------------------- assignment

def ranked(df: DataFrame, by: str, tie: list[str], n_rows: int) -> DataFrame:
    """`df` with `__rank` from 0 within each value of `by`, without gathering a value in one task."""
    n = max(1, min(MAX_BUCKETS, n_rows // BUCKET_ROWS))
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(*tie), F.lit(n)))
    totals = df.groupBy(by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(F.col(by).alias("__by"), F.col("__bucket").alias("__b"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inner = Window.partitionBy(by, "__bucket").orderBy(*tie)
    out = df.withColumn("__in", F.row_number().over(inner) - 1)
    return (out.join(shift, (F.col(by) == F.col("__by")) & (F.col("__bucket") == F.col("__b")))
            .withColumn("__rank", F.col("__before") + F.col("__in"))
            .drop("__bucket", "__in", "__by", "__b", "__before"))


def pack(parts: DataFrame, capacity: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to rows of pieces (id, piece, start, length, ids_crc32)."""
    parts = staged(parts, "pieces")
    hist = {r.length: r["count"] for r in parts.groupBy("length").count().collect()}
    out_schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()),
                               T.StructField("offset", T.LongType())])
    if not hist:
        return parts.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    table = places(plan(hist, capacity))
    step = int(max(hist.values())) + 1       # (length, rank) as one sortable number
    key = table["size"] * step + table["low"]
    names = parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            i = np.searchsorted(key, size * step + rank, "right") - 1
            past = rank - table["low"][i]
            seq = table["first"][i] + past // table["each"][i]
            off = table["at"][i] + past % table["each"][i] * size
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(seq, pa.int64()),
                                              pa.array(off, pa.int64())], names=out_schema.names)

    tie = [id_col, "piece", "start", "ids_crc32"]
    return ranked(parts, "length", tie, sum(hist.values())).mapInArrow(run, out_schema)
