"""Ranked lexical search: the best documents for each item, by a dual-tree search that prunes exactly.

A term's weight times its saturated count in a document, summed over an item's terms, is an inner product of the
item's vector (weight times repeats) and the document's (saturated counts), all whole numbers.

1. A block of items gives a vocabulary. Every text is read once and becomes its number of terms and its counts of
   the vocabulary's terms; nothing else of it can score. The counts of documents that hold a term, of documents
   and of all terms are sums over these rows.
2. Documents are put in the order of their two heaviest terms, so that neighbours are alike, by range partitions
   (a hash breaks ties, so a term that is heaviest in a third of all documents spans many partitions).
3. In a task a batch of documents becomes a hierarchy: leaves of `LEAF` documents, nodes of `FAN` children, each
   with the maximum of its documents in every coordinate. The items have such a hierarchy too. The inner product of
   the maxima of an item node and a document node bounds every score between them. A pair of nodes whose bound is
   below the weakest kth score of the node's items (at equality: whose smallest id is beyond the kth's) holds no
   result and is dropped with all that is below it; other pairs are opened, down to exact scores.
4. A first round opens only each item's most promising leaf of a batch. The kth best of these scores over all tasks
   are floors that the second round starts from. A task returns at most k rows an item; the best k of all stay.

Numbers stay below 2^53, where products in double precision are exact; longer items fall back to whole numbers.

Cases: a null or empty text has no terms, is not counted and never found; an item without terms, or whose terms
are in no document, has no rows; rows that share a document id are each ranked; items that share an id each have
their list; equal scores go by id, null last; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herdflow.llm.common import staged

#: Share of the document's length in its terms' saturation, per cent.
LENGTH_SHARE = 75
SCALE = 1_000_000_000
#: Documents of a leaf, children of a node.
LEAF, FAN = 32, 8
#: Items times vocabulary from which a block of items is closed (4 bytes each, in every task).
BLOCK_CELLS = 1 << 24
#: Documents of a range partition, about.
PART_DOCS = 100_000
NO_ID = (1 << 63) - 1

#: Bytes of terms as they are, with A-Z in lower case; every other byte as a space.
_TERMS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case."""
    return (text or b"").translate(_TERMS).split()


@dataclass
class Items:
    """A block of items: their vocabulary, vectors and hierarchy."""

    ids: list
    vocabulary: dict[bytes, int]
    counts: list[Counter]                                 # of each item: term number -> repeats
    vectors: np.ndarray | None = None                     # items x terms, in hierarchy order
    order: list[int] = field(default_factory=list)        # the item at each place of the hierarchy
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # (first places of nodes, maxima), root first

    def weigh(self, weight: np.ndarray) -> None:
        """Vectors by the terms' weights, and the hierarchy over them."""
        most = max(int(weight[t]) * n for c in self.counts for t, n in c.items())
        plain = np.zeros((len(self.ids), len(self.vocabulary)), np.int32 if most < 1 << 31 else np.int64)
        for i, c in enumerate(self.counts):
            for t, n in c.items():
                plain[i, t] = weight[t] * n
        # items whose heaviest terms are alike stand together
        heavy = [sorted(c, key=lambda t: (-weight[t] * c[t], t))[:4] for c in self.counts]
        self.order = sorted(range(len(self.ids)), key=lambda i: (heavy[i], i))
        self.vectors = plain[self.order]
        first, maxima = np.arange(len(self.ids)), self.vectors
        self.levels = [(first, maxima)]
        while len(first) > 1:
            first = first[::FAN]
            maxima = np.maximum.reduceat(maxima, np.arange(0, len(maxima), FAN), axis=0)
            self.levels.insert(0, (first, maxima))


def blocks(items: DataFrame, id_col: str, text_col: str, most_cells: int) -> Iterator[Items]:
    """The items in blocks of bounded size, read one after the other."""
    ids, counts, vocabulary = [], [], {}
    for r in items.select(F.col(id_col), F.col(text_col).cast("binary")).toLocalIterator():
        found = Counter(terms(bytes(r[1]) if r[1] is not None else None))
        if not found:
            continue
        ids.append(r[0])
        counts.append(Counter({vocabulary.setdefault(t, len(vocabulary)): n for t, n in found.items()}))
        if len(ids) * len(vocabulary) >= most_cells:
            yield Items(ids, vocabulary, counts)
            ids, counts, vocabulary = [], [], {}
    if ids:
        yield Items(ids, vocabulary, counts)


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf) of the documents with a term; the last two for terms of the vocabulary."""
    schema = "id long, n long, terms array<int>, tf array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for b in batches:
            out: list[list] = [[], [], [], []]
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ts = terms(t.as_py())
                if ts:
                    c = Counter(map(number, ts))
                    c.pop(None, None)
                    at = sorted(c)
                    for col, v in zip(out, (i, len(ts), at, [c[x] for x in at]), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32())),
                 pa.array(out[3], pa.list_(pa.int32()))], names=["id", "n", "terms", "tf"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(run, schema)


def document_frequency(counts: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs: a row a term from each task, summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            n += np.bincount(b.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in counts.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n                                 # at most a row a term of the block
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def saturated(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's coordinates from its counts and its length."""
    sizes, at = np.unique(n, return_inverse=True)
    m = np.array([100 - LENGTH_SHARE + (LENGTH_SHARE * x * n_docs) // n_terms for x in sizes.tolist()], np.int64)[at]
    return (SCALE * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


class Batch:
    """The hierarchy over a batch of documents."""

    def __init__(self, b: pa.RecordBatch, size: int, n_docs: int, n_terms: int):
        ids = b.column(0)
        self.top = np.zeros(size, np.int64)              # of the vocabulary's size, 0 between uses
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(NO_ID).to_numpy()
        lists = b.column(2)
        self.start = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).astype(np.int64)
        self.terms = lists.flatten().to_numpy()
        self.value = saturated(b.column(3).flatten().to_numpy(), np.repeat(b.column(1).to_numpy(), np.diff(self.start)), n_docs, n_terms)
        self.first = [np.arange(0, len(self.ids), LEAF)]                     # first documents of nodes, leaves first
        while len(self.first[-1]) > 1:
            self.first.append(self.first[-1][::FAN])

    def span(self, level: int, node: int) -> tuple[int, int]:
        f = self.first[level]
        return int(f[node]), int(f[node + 1]) if node + 1 < len(f) else len(self.ids)

    def maxima(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms of documents lo to hi and the largest coordinate of each, where it is above 0."""
        part = slice(self.start[lo], self.start[hi])
        np.maximum.at(self.top, self.terms[part], self.value[part])
        cols = np.flatnonzero(self.top)
        top = self.top[cols]
        self.top[cols] = 0
        return cols, top

    def matrix(self, lo: int, hi: int, cols: np.ndarray) -> np.ndarray:
        """Terms x documents of a leaf."""
        out = np.zeros((len(cols), hi - lo), np.int64)
        t, v = self.terms[self.start[lo]:self.start[hi]], self.value[self.start[lo]:self.start[hi]]
        doc = np.repeat(np.arange(hi - lo), np.diff(self.start[lo:hi + 1]))
        some = v > 0
        out[np.searchsorted(cols, t[some]), doc[some]] = v[some]
        return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact product of whole numbers: in doubles where all sums stay below 2^53."""
    if a.size and b.size and float(a.max()) * float(b.max()) * a.shape[-1] < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


class Search:
    """The best k of all documents seen, for each item of a block."""

    def __init__(self, items: Items, k: int, floors: np.ndarray | None, n_docs: int, n_terms: int):
        self.items, self.k, self.n_docs, self.n_terms = items, k, n_docs, n_terms
        self.best: list[list] = [[] for _ in items.ids]   # heaps of (score, -id, null) by place
        floors = np.ones(len(items.ids), np.int64) if floors is None else np.maximum(floors, 1)
        self.least = floors[items.order]                  # a result scores that much
        self.least_id = np.full(len(items.ids), NO_ID)    # and has, at equality, an id up to this

    def offer(self, place: int, score: int, doc: int, null: bool) -> None:
        heap = self.best[place]
        row = (score, -doc, null)
        if len(heap) < self.k:
            heapq.heappush(heap, row)
        elif row > heap[0]:
            heapq.heapreplace(heap, row)
        if len(heap) == self.k and heap[0][0] >= self.least[place]:
            self.least[place], self.least_id[place] = heap[0][0], -heap[0][1]

    def score(self, b: Batch, lo: int, hi: int, places: np.ndarray, cols: np.ndarray) -> None:
        """Exact scores of a leaf's documents for the items at `places`."""
        got = product(self.items.vectors[np.ix_(places, cols)], b.matrix(lo, hi, cols))
        row, doc = np.nonzero(got >= self.least[places][:, None])
        for i in np.lexsort((b.ids[lo + doc], -got[row, doc])).tolist():     # best first, so the kth rises early
            p, d = int(places[row[i]]), lo + int(doc[i])
            s = int(got[row[i], doc[i]])
            if s > self.least[p] or s == self.least[p] and b.ids[d] <= self.least_id[p]:
                self.offer(p, s, int(b.ids[d]), bool(b.null[d]))

    def may(self, level: int, nodes: np.ndarray, cols: np.ndarray, top: np.ndarray, least_id: int) -> np.ndarray:
        """The item nodes of a level whose bound with a document node reaches their weakest kth score."""
        first, maxima = self.items.levels[level]
        bound = product(maxima[np.ix_(nodes, cols)], top)
        weakest = np.minimum.reduceat(self.least, first)[nodes]
        keep = bound >= weakest
        if level == len(self.items.levels) - 1:           # single items: ids decide between equals
            keep &= (bound > weakest) | (least_id <= self.least_id[nodes])
        return nodes[keep]

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        n = len(self.items.levels[level + 1][0])
        return np.concatenate([np.arange(x * FAN, min(n, (x + 1) * FAN)) for x in nodes.tolist()])

    def visit(self, b: Batch, level: int, node: int, item_level: int, nodes: np.ndarray) -> None:
        """Open a document node against the item nodes that its parent could not drop."""
        lo, hi = b.span(level, node)
        cols, top = b.maxima(lo, hi)
        least_id = int(b.ids[lo:hi].min())
        last = len(self.items.levels) - 1
        nodes = self.may(item_level, nodes, cols, top, least_id)
        while len(nodes) and item_level < last and (level == 0 or len(nodes) * FAN <= 256):
            nodes, item_level = self.children(item_level, nodes), item_level + 1
            nodes = self.may(item_level, nodes, cols, top, least_id)
        if not len(nodes):
            return
        if level == 0:
            self.score(b, lo, hi, nodes, cols)
            return
        below = range(node * FAN, min(len(b.first[level - 1]), (node + 1) * FAN))
        for child in below:
            self.visit(b, level - 1, child, item_level, nodes)

    def search(self, rb: pa.RecordBatch) -> None:
        if rb.num_rows:
            b = Batch(rb, len(self.items.vocabulary), self.n_docs, self.n_terms)
            self.visit(b, len(b.first) - 1, 0, 0, np.zeros(1, np.int64))

    def probe(self, rb: pa.RecordBatch) -> None:
        """Score each item on the leaf of the batch that bounds it highest."""
        if not rb.num_rows:
            return
        b = Batch(rb, len(self.items.vocabulary), self.n_docs, self.n_terms)
        most, leaf = np.zeros(len(self.items.ids), np.int64), np.full(len(self.items.ids), -1)
        found = []
        for x in range(len(b.first[0])):
            cols, top = b.maxima(*b.span(0, x))
            found.append(cols)
            bound = product(self.items.vectors[:, cols], top)
            better = bound > most
            most[better], leaf[better] = bound[better], x
        for x in np.unique(leaf[leaf >= 0]).tolist():
            self.score(b, *b.span(0, x), np.flatnonzero(leaf == x), found[x])

    def rows(self) -> pa.RecordBatch:
        got = [(self.items.order[p], None if null else -d, s) for p, heap in enumerate(self.best) for s, d, null in heap]
        item, doc, score = zip(*got, strict=True) if got else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                          names=["item", "doc", "score"])


def candidates(vectors: DataFrame, items: Items, k: int, floors: np.ndarray | None, n_docs: int, n_terms: int) -> DataFrame:
    """(item, doc, score): each task's best, by a probe where there are no floors yet, else by the dual-tree search."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Search(items, k, floors, n_docs, n_terms)
        for b in batches:
            s.probe(b) if floors is None else s.search(b)
        yield s.rows()

    return vectors.select("id", "n", "terms", "tf").mapInArrow(run, "item int, doc long, score long")


def best(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def arranged(counts: DataFrame, weight: np.ndarray, n_docs: int) -> DataFrame:
    """The documents that hold a term of the block, like next to like."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            size = lists.value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(size)), size)
            t = lists.flatten().to_numpy()
            by = np.lexsort((t, -weight[t], doc))
            start = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
            keys = [t[by][start], np.where(size > 1, t[by][np.minimum(start + 1, max(0, len(t) - 1))], -1)] if len(t) else [size, size]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x, pa.int32()) for x in keys]], names=[*b.schema.names, "key1", "key2"])

    held = counts.filter(F.size("terms") > 0).mapInArrow(run, "id long, n long, terms array<int>, tf array<int>, key1 int, key2 int")
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["key1", "key2", F.xxhash64("n", "terms", "tf"), F.xxhash64("id")]
    return held.repartitionByRange(max(parts, -(-n_docs // PART_DOCS)), *by).sortWithinPartitions(*by)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", doc_text: str = "text",
           item_text: str = "text", block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(item id, rank, document id, score): the k best documents of each item, a pass over the documents a block of items."""
    spark = docs.sparkSession
    out = None
    for block in blocks(items, item_id, item_text, block_cells):
        counts = staged(term_counts(docs, block.vocabulary, doc_id, doc_text), "search-counts")
        total = counts.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not total.docs:
            break
        weight = weights(document_frequency(counts, len(block.vocabulary)), total.docs)
        block.weigh(weight)
        vectors = staged(arranged(counts, weight, total.docs), "search-vectors")
        probed = best(candidates(vectors, block, k, None, total.docs, total.terms), k).filter(F.col("rank") == k)
        floors = np.zeros(len(block.ids), np.int64)
        for r in probed.collect():                        # at most a row an item of the block
            floors[r.item] = r.score
        found = best(candidates(vectors, block, k, floors, total.docs, total.terms), k)
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"item int, __id {items.schema[item_id].dataType.simpleString()}")
        rows = found.join(F.broadcast(ids), "item").select(F.col("__id").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
        out = rows if out is None else out.unionAll(rows)
    if out is None:
        kinds = {item_id: items.schema[item_id].dataType.simpleString(), "rank": "int", doc_id: "long", "score": "long"}
        return spark.createDataFrame([], ", ".join(f"{a} {b}" for a, b in kinds.items()))
    return out


def search_sql(k: int = 10) -> str:
    """DuckDB SQL for the same result over `documents` and `benchmark`."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = f"regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH items AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
it AS (SELECT i, term, count(*) AS repeats FROM (SELECT i, unnest({found}) AS term FROM items) GROUP BY ALL),
docs AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
dw AS (SELECT d, unnest({found}) AS term FROM docs),
lens AS (SELECT d, count(*) AS n FROM dw GROUP BY d),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lens),
tf AS (SELECT d, term, count(*) AS tf FROM dw SEMI JOIN it USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * whole.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, whole.docs),
impact AS (SELECT d, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * n * whole.docs) // whole.terms)) AS v
           FROM tf JOIN lens USING (d), whole),
scored AS (SELECT i, d, CAST(sum(repeats * w * v) AS BIGINT) AS score FROM it JOIN w USING (term) JOIN impact USING (term) GROUP BY i, d),
placed AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored JOIN items USING (i) JOIN docs USING (d) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= {k}
"""
