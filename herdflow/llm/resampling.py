"""Importance resampling of documents to a target, ranked by parallel sorting by regular sampling.

1. Every text becomes its words (runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower
   case) and its features, the runs of 1 to `n` words; a feature's bucket is the crc32 of its UTF-8 bytes modulo
   `buckets`. The bucket numbers of a text are written as one array, so texts are read once.
2. Bucket counts over all documents and over all target texts give a table of `buckets` whole gains; a document's
   weight is the sum of its features' gains, one numpy look-up. A Gumbel number from a hash of the id is added:
   the highest scores are a draw without replacement in proportion to exp(weight / 1000).
3. Ranks: partitions are sorted (runs) and every g-th row of each run is a regular sample. The sorted samples give
   splitters of equal share. A first pass counts the rows of each run between splitters, and the sums are the
   exact number of rows before each segment. Segments that begin within the draw are exchanged, sorted inside
   (merged) and numbered on from their prefix count. The key ends with the row's own place, so rows of equal score
   and id are split between segments like any others.

The driver sees the bucket counts, one number a segment and at most `SAMPLES` + runs samples, whatever the table.

Cases: a null or empty text has no features, weight 0 and no rank where `least_words` is above 0; a null id takes part with
the hash of an empty id and comes last among equal scores; rows that share an id are each ranked; an empty
table gives an empty result; an empty target has T = 0; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdflow.llm.common import staged

BUCKETS = 10_000
#: Regular samples that the driver sorts, besides one a run.
SAMPLES = 200_000
#: Rows of a segment, about.
SEGMENT_ROWS = 250_000
#: Distinct features whose bucket a task remembers.
MEMO = 500_000

#: Bytes of words as they are, with A-Z in lower case; every other byte as a space.
_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def number(buckets: int) -> type:
    """The type of bucket numbers in arrays."""
    return np.uint16 if buckets <= 1 << 16 else np.uint32


class Buckets(dict):
    """The bucket of a feature, remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        b = zlib.crc32(feature) % self.buckets
        if len(feature) <= 64:
            self[feature] = b
        return b

    def of(self, text: bytes | None, n: int) -> tuple[np.ndarray, int]:
        """The buckets of all features of a text, and the number of its words."""
        w = (text or b"").translate(_WORDS).split()
        runs = [w] + [[b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] for k in range(2, n + 1)]
        return np.array([self[x] for run in runs for x in run], number(self.buckets)), len(w)


def featured(docs: DataFrame, n: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, the features' buckets as an array of `number(buckets)`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets(buckets)
        for b in batches:
            found = [bucket.of(t.as_py(), n) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([w for _, w in found], pa.int64()), pa.array([len(f) for f, _ in found], pa.int64()),
                 pa.array([f.tobytes() for f, _ in found], pa.binary())], names=["id", "n_words", "n_features", "features"])

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return picked.mapInArrow(run, "id long, n_words long, n_features long, features binary")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs: a row a bucket from each task, summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for f in b.column(0):
                n += np.bincount(np.frombuffer(f.as_buffer(), number(buckets)), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = features.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():                                              # at most a row a bucket
        out[r.bucket] = r.n
    return out


def gains(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of each bucket's smoothed share in the target and in the documents, floored."""
    n, big_s, big_t = len(s), int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log(((y + 1) * (big_s + n)) / ((x + 1) * (big_t + n))))
                     for x, y in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def gumbel(h: int) -> int:
    """A thousand times a Gumbel number from 32 hash bits, floored."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(id, n_words, n_features, weight, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight = [int(gain[np.frombuffer(f.as_buffer(), number(len(gain)))].sum()) for f in b.column(3)]
            score = [w + gumbel(h) for w, h in zip(weight, b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                                             names=["id", "n_words", "n_features", "weight", "score"])

    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    schema = "id long, n_words long, n_features long, weight long, score long"
    return features.select("id", "n_words", "n_features", "features", h.alias("h")).mapInArrow(run, schema)


def order() -> list[Column]:
    """The order of ranks: highest score, then smaller id (null last), then the row's own place in its run."""
    return [F.desc("score"), F.asc_nulls_last("id"), F.asc("place")]


def sorted_runs(rows: DataFrame) -> DataFrame:
    """The rows sorted within partitions, with `place`: the partition and the place in it, unlike any other row's."""
    return staged(rows.sortWithinPartitions(F.desc("score"), F.asc_nulls_last("id"))
                  .withColumn("place", F.monotonically_increasing_id()), "sorted-runs")


class Splitters:
    """Keys between segments, and the segment of rows."""

    def __init__(self, keys: list[tuple[int, int | None, int]]):
        self.score = np.array([-s for s, _, _ in keys], np.int64)
        self.no_id = np.array([i is None for _, i, _ in keys], bool)
        self.id = np.array([i or 0 for _, i, _ in keys], np.int64)
        self.place = np.array([p for _, _, p in keys], np.int64)

    def segment(self, score: pa.Array, ids: pa.Array, place: pa.Array) -> np.ndarray:
        """The number of splitters at or before each row."""
        n = len(self.score)
        cols = [np.concatenate(x) for x in (
            (self.place, place.to_numpy()), (self.id, ids.fill_null(0).to_numpy()),
            (self.no_id, ids.is_null().to_numpy(zero_copy_only=False)), (self.score, -score.to_numpy()),
        )]
        own = np.arange(len(cols[0])) >= n                   # a splitter stands before the row that it is
        at = np.lexsort((own, *cols))
        before = np.cumsum(at < n)
        out = np.empty(len(at), np.int64)
        out[at] = before
        return out[n:]


def splitters(runs: DataFrame, n: int, segments: int) -> Splitters:
    """Splitters of about equal share from every g-th row of each run."""
    step = max(1, -(-n // SAMPLES), n // (segments * 32))
    # the low 33 bits of a place count the rows of a run from 0
    taken = runs.filter(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) % step == step // 2)
    samples = [tuple(r) for r in taken.select("score", "id", "place").collect()]   # at most SAMPLES, and one a run
    samples.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    cuts = sorted({len(samples) * i // segments for i in range(1, segments)} - {0})
    return Splitters([samples[i] for i in cuts])


def in_segments(runs: DataFrame, cuts: Splitters) -> DataFrame:
    """The rows of the runs with their segment."""
    names = runs.columns
    at = [names.index(c) for c in ("score", "id", "place")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cuts.segment(*[b.column(i) for i in at]))], names=[*names, "segment"])

    return runs.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema) + ", segment long")


def ranked(runs: DataFrame, n: int, draw: int) -> DataFrame:
    """The rows of sorted runs with `rank`: 1, 2, 3... for the first `draw` of the `n` rows in order, else null."""
    spark = runs.sparkSession
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SEGMENT_ROWS))
    dealt = in_segments(runs, splitters(runs, n, segments))
    size = {r.segment: r.n for r in dealt.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a segment
    before, total = {}, 0
    for s in sorted(size):
        before[s] = total
        total += size[s]
    drawn = [s for s in before if before[s] < draw]
    last = max(drawn, default=-1)            # segments up to this one hold the draw
    names = dealt.columns

    def count_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            seg = b.column(names.index("segment")).to_numpy()
            rank = np.empty(len(seg), np.int64)
            for s in np.unique(seg).tolist():
                own = np.flatnonzero(seg == s)
                start = before[s] + seen.get(s, 0)
                rank[own] = np.arange(start + 1, start + 1 + len(own))
                seen[s] = seen.get(s, 0) + len(own)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank, mask=rank > draw)], names=[*names, "rank"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema) + ", rank long"
    first = (dealt.filter(F.col("segment") <= last).repartitionById(max(1, last + 1), F.col("segment").cast("int"))
             .sortWithinPartitions("segment", *order()).mapInArrow(count_on, schema))
    return first.unionAll(dealt.filter(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))).drop("segment", "place")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, n: int = 1, buckets: int = BUCKETS,
             seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) for every document; `percent` of those of `least_words` words are drawn."""
    features = staged(featured(docs, n, buckets, id_col, text_col), "resample-features")
    aim = featured(target.withColumn("__none", F.lit(None).cast("long")).select("__none", target_text), n, buckets, "__none", target_text)
    gain = gains(bucket_counts(features, buckets), bucket_counts(aim, buckets))
    rows = scored(features, gain, seed)
    runs = sorted_runs(rows)
    may = runs.filter(F.col("n_words") >= least_words)
    total = may.count()
    out = ranked(may, total, percent * total // 100)
    rest = runs.filter(F.col("n_words") < least_words).drop("place").withColumn("rank", F.lit(None).cast("long"))
    return out.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, percent: int = 10, id_col: str = "doc_id", **how) -> DataFrame:
    """The drawn documents with all their columns; rows that share an id go together if one of them is drawn."""
    ids = resample(docs, target, percent, id_col=id_col, **how).filter("rank IS NOT NULL").select(F.col(id_col).alias("__drawn")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(ids["__drawn"]), "left_semi")


def resample_sql(percent: int = 10, least_words: int = 20, buckets: int = BUCKETS, seed: int = 2024) -> str:
    """DuckDB SQL for single words over `documents` and `benchmark`; crc32 is computed a byte at a time."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE bits(b, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT b, k + 1, {bit} FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY b) AS cs FROM bits WHERE k = 8
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents
), dw AS (SELECT r, unnest(w) AS word FROM docs
), tw AS (SELECT unnest({words}) AS word FROM benchmark
), distinct_words AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM tw)
), sums(word, h, i, c) AS (
  SELECT word, h, 0, CAST(4294967295 AS BIGINT) FROM distinct_words
  UNION ALL
  SELECT word, h, i + 1, xor(c >> 8, cs[1 + (xor(c, CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) & 255)])
  FROM sums, crc_table WHERE 2 * i < length(h)
), bucketed AS (
  SELECT word, xor(c, 4294967295) % {buckets} AS b FROM sums WHERE 2 * i = length(h)
), s AS (SELECT b, count(*) AS n FROM dw JOIN bucketed USING (word) GROUP BY b
), t AS (SELECT b, count(*) AS n FROM tw JOIN bucketed USING (word) GROUP BY b
), whole AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS s, coalesce((SELECT sum(n) FROM t), 0) AS t
), gain AS (
  SELECT s.b, floor(1000 * ln((CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (whole.s + {buckets}))
                              / (CAST(s.n + 1 AS DOUBLE) * (whole.t + {buckets})))) AS g FROM s LEFT JOIN t USING (b), whole
), weighed AS (
  SELECT r, count(*) AS n, sum(g) AS weight FROM dw JOIN bucketed USING (word) JOIN gain USING (b) GROUP BY r
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
              AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (r)
), placed AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS p, {percent} * count(*) OVER () // 100 AS k
  FROM scored WHERE n_features >= {least_words}
)
SELECT doc_id, n_features, weight, score, CASE WHEN p <= k THEN p END AS rank FROM placed
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < {least_words}
"""
