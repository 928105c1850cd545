"""Toxicity scores by a character n-gram linear classifier with naive Bayes feature scales.

A text's features are the hashed character n-grams (4, 6 and 8 characters, over the words in lower
case, with a space at either end) that occur in it, each counted once. From labelled text the log
ratio of a feature's smoothed share in toxic and in clean rows is taken (naive Bayes), features
are scaled by it, and a logistic regression is fitted on the scaled features.

Anything but letters and digits counts as a space. The fit sees a bounded sample, in one executor task: at most `per_class`
labelled rows of each label, those with the smallest hash of their id, and of these at most `sample_bytes` of features; rows
are weighted so that the classes keep their true shares. The labels of all training rows are counted. The driver gets the
model only. Scoring covers whole texts of all rows, with no shuffle;
the model is two numbers per hash bucket, whatever the corpus.

Cases: a null or empty text has no features and gets the score of the bias; null labels are not
learned from, a document with several labels counts as toxic if one says so; without rows of both
labels every score is the share of toxic rows (0 without labels); a null id is never held out;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

N_GRAMS = (4, 6, 8)
BITS = 19
#: Characters handled at once, whatever the length of a text.
PART_CHARS = 1 << 18


@dataclass
class Model:
    bias: float
    weight: np.ndarray       # per hash bucket: the learned weight times the naive Bayes scale


def _is_word_char() -> np.ndarray:
    """For each code point below 65536 whether it is a letter or digit."""
    return np.array([chr(c).isalnum() for c in range(1 << 16)])


class Features:
    """Distinct hashed n-grams of a text: hash buckets, in order."""

    def __init__(self) -> None:
        self.seen = np.zeros(1 << BITS, bool)
        self.is_word = _is_word_char()

    def __call__(self, text: str | None) -> np.ndarray:
        found = False
        for part in self.parts((text or "").lower()):
            found |= self.mark(part)
        if not found:
            return np.zeros(0, np.int32)
        out = np.flatnonzero(self.seen).astype(np.int32)
        self.seen[out] = False
        return out

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts of bounded size that overlap by the longest n-gram and its ends."""
        for i in range(0, max(1, len(text)), PART_CHARS):
            yield text[max(0, i - max(N_GRAMS) - 1):i + PART_CHARS]

    def mark(self, text: str) -> bool:
        chars = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
        gap = ~self.is_word[np.minimum(chars, (1 << 16) - 1)] & (chars < 1 << 16)
        chars = np.where(gap, np.uint32(32), chars)
        gaps = np.concatenate(([0], np.cumsum(gap)))
        h = chars * np.uint32(0x9E3779B1)
        some = False
        for n in range(2, max(N_GRAMS) + 1):
            if len(chars) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + chars[n - 1:] * np.uint32(0xC2B2AE35)
            if n not in N_GRAMS:
                continue
            # inside words: spaces may stand at the ends only, and not at both of two
            inner = gaps[n - 1:-1] - gaps[1:-n + 1] if n > 2 else (gap[:-1] & gap[1:])
            mixed = h[inner == 0]
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x27D4EB2F)
            self.seen[mixed >> np.uint32(32 - BITS)] = True
            some |= len(mixed) > 0
        return some


def held_out(id_col: Column) -> Column:
    """Rows that labels are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Rows of the sample whose features are expanded at once while fitting.
FIT_ROWS = 256


def fit_rows(rows: list[tuple[np.ndarray, int, float]], smooth: float = 1.0, decay: float = 1e-3,
             steps: int = 60) -> Model:
    """Fit on (features, label, weight) rows: naive Bayes scales, then weighted logistic regression."""
    n = 1 << BITS
    y = np.array([t for _, t, _ in rows], float)
    weight = np.array([w for _, _, w in rows], float)
    share = float((weight * y).sum() / weight.sum())
    of = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
    for ids, t, _ in rows:
        of[t][ids] += 1
    total = [max(1, int((y == t).sum())) for t in (0, 1)]
    scale = np.log((of[1] + smooth) / (total[1] + 2 * smooth)) - np.log((of[0] + smooth) / (total[0] + 2 * smooth))
    used = np.flatnonzero(of[0] + of[1] > 2)  # a feature of one or two rows only names those rows
    place = np.full(n, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    parts = []                               # (rows, their features, the row of each feature)
    for i in range(0, len(rows), FIT_ROWS):
        own = [place[ids] for ids, _, _ in rows[i:i + FIT_ROWS]]
        own = [ids[ids >= 0] for ids in own]
        at = np.repeat(np.arange(len(own), dtype=np.int32), [len(ids) for ids in own])
        parts.append((slice(i, i + len(own)), np.concatenate(own), at))
    s = scale[used]
    bias, w = float(np.log(share / (1 - share))), np.zeros(len(used))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    per = weight / weight.sum()
    for step in range(1, steps + 1):         # Adam on the whole sample
        g = np.zeros(len(used) + 1)
        for at_rows, ids, at in parts:
            z = bias + np.bincount(at, (w * s)[ids], at_rows.stop - at_rows.start)
            err = per[at_rows] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[at_rows])
            g[:-1] += np.bincount(ids, err[at], len(used)) * s
            g[-1] += err.sum()
        g[:-1] += decay * w
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        d = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w -= d[:-1]
        bias -= d[-1]
    out = np.zeros(n)
    out[used] = w * s
    return Model(bias, out)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, sample_bytes: int = 64 << 20, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the labels of rows that are not held out, in one task, on a sample that is bounded twice.

    Of each label the `per_class` labelled ids with the smallest hash are looked up; their rows are taken in that order as
    long as their features (4 bytes each) fit into `sample_bytes` a label, one row at least. Only the model comes back.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    total = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(total) < 2:
        share = float(1 in total)
        return Model(40.0 if share else -40.0, np.zeros(1 << BITS))
    pick = [known.filter(F.col("label") == t).orderBy(F.xxhash64("id"), "id").limit(per_class) for t in (0, 1)]
    sample = F.broadcast(pick[0].unionAll(pick[1]))          # at most 2 * per_class rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id")
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("ids", T.BinaryType())])

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            ids = [features(t.as_py()).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], names=schema.names)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, int]] = []
        held = [0, 0]
        for b in batches:
            for t, f in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                ids = np.frombuffer(f.as_py(), np.int32)
                if not held[t] or held[t] + ids.nbytes <= sample_bytes:
                    rows.append((ids, t))
                    held[t] += max(1, ids.nbytes)
        n = [sum(t == x for _, t in rows) for x in (0, 1)]
        if n[0] and n[1]:
            m = fit_rows([(f, t, total[t] / n[t]) for f, t in rows])
        else:
            m = Model(40.0 if n[1] else -40.0, np.zeros(1 << BITS))
        at = np.flatnonzero(m.weight)
        yield pa.RecordBatch.from_arrays([pa.array([m.bias]), pa.array([at.tobytes()], pa.binary()), pa.array([m.weight[at].tobytes()], pa.binary())],
                                         names=["bias", "at", "weight"])

    found = texts.select("label", F.xxhash64("id").alias("h"), "text").mapInArrow(features_of, schema)
    # one task for the sample; equal hashes go by their features, so reruns agree
    one = found.repartition(1).sortWithinPartitions("label", "h", "ids").mapInArrow(learn, "bias double, at binary, weight binary")
    r = one.first()
    weight = np.zeros(1 << BITS)
    weight[np.frombuffer(r.at, np.int64)] = np.frombuffer(r.weight)
    return Model(r.bias, weight)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted (1 if score >= threshold)."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType())])
    picked = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            s = [scorer(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64())], names=schema.names)

    return picked.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.features = model, Features()

    def __call__(self, text: str | None) -> float:
        z = self.model.bias + float(self.model.weight[self.features(text)].sum())
        return 1 / (1 + np.exp(-min(max(z, -40.0), 40.0)))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text scores below `threshold`, with all their columns."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            keep = [scorer(t.as_py()) < threshold for t in b.column(names.index(text_col))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
