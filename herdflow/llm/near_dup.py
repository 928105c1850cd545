"""Near-duplicate documents by tiers of prefix bands over MinHash sketches, confirmed on whole sets.

1. Every text becomes its set of word shingles (64-bit hashes), a 128-bit key of the set and a
   sketch of 256 minima. Texts with equal sets are one class; one of them stands for it.
2. The forest has trees, each an order of the sketch's values; a tree's region is the classes that
   share its first values: 3, 6 or 12 of them by level. There is no neighbour search along the sorted
   orders; full comparison inside a region replaces it. A region of more than `region_rows` classes is not searched, its classes go on to the next
   level of more values and more trees (`LEVELS`). A pair of similarity 0.8 shares no region with a chance of
   about 0.00005, 0.0002 and 0.0033 by level (simulated: the trees of a level draw on the same 256 values). The deepest regions are dealt to blocks.
3. Inside a region every sketch is compared with every other (label order breaks ties). First round: pairs along a maximum
   spanning forest of the estimates are confirmed on the whole sets and links joined into
   components. Second round: in regions that still hold several components, all pairs of different
   components whose estimate allows the similarity are confirmed (in a deepest region: the blocks
   of what is outside its largest component against all its blocks). So a group of n near copies costs
   about n confirmations, not n^2, and no link that would join components is left out.
4. Components of the links; a document's component is the smallest id it reaches.

An estimate rules a pair out at `MARGIN` standard errors below the threshold.

Cases: null, empty and blank texts have no shingles and are linked with nothing; fewer words than a
shingle are one shingle; a null id keeps a null component and is kept; rows that share an id and
differ in text are separate; repeated rows are one class; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.llm.common import few, staged
from herdflow.llm.components import components
from herdflow.llm.shingles import Sketcher, mix, set_key, shingle_set

SKETCH = 256
#: (trees, values) of each level.
LEVELS = ((16, 3), (32, 6), (128, 12))
REGION_ROWS = 2048
MARGIN = 4.5


def tree_orders(seed: int = 5) -> list[np.ndarray]:
    """The order in which each tree reads the sketch."""
    rng = np.random.default_rng(seed)
    return [rng.permutation(SKETCH)[:16] for _ in range(max(t for t, _ in LEVELS))]


def least_matches(threshold: float) -> int:
    """Equal sketch values below which a pair is ruled out."""
    return int(SKETCH * threshold - MARGIN * (SKETCH * threshold * (1 - threshold)) ** 0.5)


def shingled(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """doc, n, cls (64 bits of the set key; null without shingles), key2, sketch."""
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("cls", T.LongType()), T.StructField("key2", T.LongType()),
                           T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(SKETCH)
        for b in batches:
            n, cls, key2, sk = [], [], [], []
            for t in b.column(1):
                s = shingle_set(t.as_py(), k)
                k1, k2 = set_key(s) if len(s) else (None, None)
                n.append(len(s))
                cls.append(k1)
                key2.append(k2)
                sk.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                                              pa.array(key2, pa.int64()), pa.array(sk, pa.binary())], names=schema.names)

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, schema)


def region_keys(nodes: DataFrame, level: int) -> DataFrame:
    """(tree, region, cls): the region of each class in each tree of the level."""
    trees, depth = LEVELS[level]
    orders = tree_orders()[:trees]
    schema = "tree int, region long, cls long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cls = b.column(0).to_numpy()
            sk = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, SKETCH)
            for t, order in enumerate(orders):
                key = np.full(len(cls), t, np.uint64)
                for i in order[:depth]:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sk[:, i])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cls), t), pa.int32()), pa.array(key.view(np.int64)),
                                                  pa.array(cls)], names=["tree", "region", "cls"])

    return nodes.select("cls", "sketch").mapInArrow(run, schema)


def regions(nodes: DataFrame, region_rows: int) -> DataFrame:
    """(level, tree, region, block, cls, size) for all regions of two classes or more, those of equal classes in a level once."""
    out = None
    for level in range(len(LEVELS)):
        keys = staged(region_keys(nodes, level), "forest")
        size = keys.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("lead"),
                                                  F.expr("bit_xor(xxhash64(cls))").alias("members")).filter("size > 1")
        # a region of the same classes as an earlier tree's brings no other pairs together
        once = size.groupBy("size", "lead", "members", F.when(F.col("size") > region_rows, F.col("tree")).alias("own"))
        size = once.agg(F.min(F.struct("tree", "region")).alias("r")).select("r.tree", "r.region", "size", "lead")
        size = staged(size, "region-sizes")      # plain sides, so a hot region's join can be split
        sized = staged(keys.join(size, ["tree", "region"]), "regions")
        fits = sized.filter(F.col("size") <= region_rows).withColumn("block", F.lit(0))
        over = sized.filter(F.col("size") > region_rows)
        last = level == len(LEVELS) - 1
        if last:                             # blocks of a deepest region share its first class
            blocks = F.ceil(F.col("size") / (region_rows - 1)).cast("int")
            dealt = over.withColumn("block", F.pmod(F.xxhash64("cls", "tree"), blocks).cast("int"))
            lead = over.filter("cls = lead").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
            fits = fits.unionAll(dealt.filter("cls <> lead").unionAll(lead).select(*fits.columns))
        part = fits.select(F.lit(level).alias("level"), "tree", "region", F.col("block").cast("long"), "cls", "size")
        out = part if out is None else out.unionAll(part)
        if last or over.isEmpty():
            break
        nodes = nodes.join(over.select("cls").distinct(), "cls", "left_semi")
    return staged(out, "region-rows")


def matches(sk: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Equal sketch values of each of `rows` with each of `others`."""
    out = np.empty((len(rows), len(others)), np.int16)
    step = max(1, (1 << 22) // (SKETCH * max(1, len(others))))
    for i in range(0, len(rows), step):
        out[i:i + step] = (sk[rows[i:i + step], None, :] == sk[None, others, :]).sum(axis=2, dtype=np.int16)
    return out


def spanning(sk: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Pairs along a maximum spanning forest of the sketch matches (Prim, one row at a time)."""
    n = len(sk)
    best, via = np.full(n, -1, np.int32), np.full(n, -1)
    todo = np.ones(n, bool)
    out = []
    for _ in range(n):
        at = int(np.argmax(np.where(todo, best, -2)))
        if best[at] >= least:
            out.append((int(via[at]), at))
        todo[at] = False
        left = np.flatnonzero(todo)
        if not len(left):
            break
        m = (sk[left] == sk[at]).sum(axis=1)
        better = left[m > best[left]]
        best[better], via[better] = m[m > best[left]], at
    return out


PAIRS = "a long, b long"


class Rows:
    """Complete region blocks of sorted (level, tree, region, block, cls, comp, sketch, side[, shingles]) rows."""

    def __init__(self, t: pa.Table, keys: np.ndarray, cuts: np.ndarray):
        self.t, self.keys, self.cuts = t, keys, cuts
        self.cls, self.comp, self.side = (t.column(i).to_numpy() for i in (4, 5, 7))
        self.sk = np.frombuffer(b"".join(t.column(6).to_pylist()), np.uint16).reshape(-1, SKETCH)

    def groups(self, least_rows: int) -> Iterator[tuple[tuple, slice]]:
        """Key and rows of each block of at least that many rows."""
        for lo, hi in zip(self.cuts[:-1], self.cuts[1:], strict=True):
            if hi - lo >= least_rows:
                yield tuple(self.keys[lo]), slice(lo, hi)

    def sets(self, at: slice) -> list[np.ndarray]:
        """The shingle sets of a block's rows."""
        return [np.frombuffer(v.as_buffer(), np.uint64) for v in self.t.column(8).slice(at.start, at.stop - at.start)]

    def twos(self) -> np.ndarray:
        """First rows of the blocks of two rows."""
        return self.cuts[:-1][np.diff(self.cuts) == 2]


def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    """Sorted batches as runs of complete region blocks; the last block waits for the next batch."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        keys, cuts = _cuts(t)
        if len(cuts):
            yield Rows(t.slice(0, cuts[-1]), keys, np.concatenate(([0], cuts)))
        rest = t.slice(cuts[-1] if len(cuts) else 0)
    if rest is not None and rest.num_rows:
        keys, cuts = _cuts(rest)
        yield Rows(rest, keys, np.concatenate(([0], cuts, [rest.num_rows])))


def _cuts(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.stack([t.column(i).to_numpy() for i in range(4)], axis=1)
    return keys, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1


def pairs_table(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a.min(axis=1)), pa.array(a.max(axis=1))], names=["a", "b"])


def in_label_order(g: tuple, cls: np.ndarray, sk: np.ndarray) -> np.ndarray:
    """Rows sorted by the tree's label, so that neighbours share the longest prefixes."""
    order = tree_orders()[g[1]]
    return np.lexsort((cls, *(sk[:, i] for i in order[::-1])))


def spanning_pairs(rows: DataFrame, least: int) -> DataFrame:
    """First round: the spanning pairs of every region."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in complete(batches):
            i = rows_.twos()
            i = i[(rows_.sk[i] == rows_.sk[i + 1]).sum(axis=1) >= least]
            pairs = list(zip(rows_.cls[i].tolist(), rows_.cls[i + 1].tolist(), strict=True))
            for g, at in rows_.groups(3):
                cls, sk = rows_.cls[at], rows_.sk[at]
                order = in_label_order(g, cls, sk)
                cls = cls[order]
                pairs += [(cls[a], cls[b]) for a, b in spanning(sk[order], least)]
            if pairs:
                yield pairs_table(pairs)

    return rows.mapInArrow(run, PAIRS).distinct()


class Joined:
    """Components that links of one region have joined."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, c: int) -> int:
        while c in self.up:
            c = self.up[c]
        return c

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def crossing_links(rows: DataFrame, least: int, percent: int) -> DataFrame:
    """Second round: links between different components of a region, confirmed on the whole sets.

    Every pair of different components that the sketch doesn't rule out is confirmed, nearest
    first, unless links found in the region have joined the two by then.
    """
    orders = tree_orders()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in complete(batches):
            links: list[tuple[int, int]] = []
            for g, at in rows_.groups(2):
                cls, comp, sk, side = rows_.cls[at], rows_.comp[at], rows_.sk[at], rows_.side[at]
                if side.any():                # a block of a wide region: its second side against its first
                    x_all, y_all, main = np.flatnonzero(side == 2), np.flatnonzero(side == 1), None
                else:
                    values, of, count = np.unique(comp, return_inverse=True, return_counts=True)
                    if len(values) < 2:
                        continue
                    main = of == count.argmax()
                    x_all = np.flatnonzero(~main)
                    y_all = np.concatenate([np.flatnonzero(main), x_all])
                joined = Joined()
                sets = rows_.sets(at)
                for i in range(0, len(x_all), 64):
                    x = x_all[i:i + 64]
                    same = matches(sk, x, y_all)
                    ok = (same >= least) & (comp[x][:, None] != comp[y_all][None, :])
                    if main is not None:      # each pair once
                        ok &= main[y_all][None, :] | (y_all[None, :] > x[:, None])
                    r, c = np.nonzero(ok)
                    order = np.argsort(-same[r, c], kind="stable")
                    p, q = x[r[order]], y_all[c[order]]
                    # a pair that an earlier tree of the level brings together is left to that tree
                    new = np.ones(len(p), bool)
                    for t in range(int(g[1])) if main is not None else ():
                        prefix = orders[t][:LEVELS[g[0]][1]]
                        new &= ~(sk[p][:, prefix] == sk[q][:, prefix]).all(axis=1)
                    for a, b in zip(p[new].tolist(), q[new].tolist(), strict=True):
                        if joined.find(int(comp[a])) != joined.find(int(comp[b])) and similar(sets[a], sets[b], percent):
                            joined.join(int(comp[a]), int(comp[b]))
                            links.append((int(cls[a]), int(cls[b])))
            if links:
                yield pairs_table(links)

    return rows.mapInArrow(run, PAIRS).distinct()


KEY = ["level", "tree", "region", "block"]


def with_sketch(rows: DataFrame, nodes: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Region rows (with comp and side) and their sketches and sets, each region block together in one partition."""
    t = rows.join(nodes.select("cls", "sketch"), "cls").select(*KEY, "cls", "comp", "sketch", "side")
    if sets is not None:
        t = t.join(sets, "cls").select(*t.columns, "shingles")
    return t.repartition(*KEY).sortWithinPartitions(*KEY)


def second_rows(found: DataFrame, touched: DataFrame, comps: DataFrame, region_rows: int) -> DataFrame:
    """Rows of the second round: regions that hold several components.

    A deepest region that was dealt to blocks is dealt anew: the classes outside its largest
    component (side 2) meet all its classes (side 1), a block of either at a time.
    """
    lined = (found.join(touched, "cls", "left_semi").join(comps.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("comp", F.coalesce("component", "cls")).drop("component"))
    lined = staged(lined, "second-rows")
    narrow = lined.filter(F.col("size") <= region_rows)
    several = narrow.groupBy(*KEY).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select(*KEY)
    out = narrow.join(several, KEY, "left_semi").select(*KEY, "cls", "comp", F.lit(0).alias("side"))
    wide = lined.filter(F.col("size") > region_rows).select("level", "tree", "region", "cls", "comp").distinct()
    if wide.isEmpty():
        return out
    key = KEY[:3]
    sizes = wide.groupBy(*key, "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy(*key).agg(F.max_by("comp", "n").alias("main"), F.max("n").alias("most"), F.sum("n").alias("all"))
    sizes = sizes.filter("all > most").withColumns({"b1": F.ceil(F.col("all") / region_rows), "b2": F.ceil((F.col("all") - F.col("most")) / region_rows)})
    wide = wide.join(sizes, key)
    one = (wide.withColumn("b", F.pmod(F.xxhash64("cls"), "b1")).withColumn("m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b2") - 1)))
           .withColumn("side", F.lit(1)))
    two = (wide.filter("comp <> main").withColumn("m", F.pmod(F.xxhash64("cls"), "b2"))
           .withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b1") - 1))).withColumn("side", F.lit(2)))
    dealt = [x.select(*key, (F.col("b") * F.col("b2") + F.col("m")).alias("block"), "cls", "comp", "side") for x in (one, two)]
    return out.unionAll(dealt[0]).unionAll(dealt[1])


def class_sets(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(cls, shingles) of the wanted classes (cls, doc): the sets of their documents' whole texts."""
    schema = "cls long, shingles binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, sets = [], []
            for want, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = shingle_set(t.as_py(), k)
                if len(s) and set_key(s)[0] == want:      # another text may share the id
                    cls.append(want)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "shingles"])

    texts = docs.select(F.col(id_col).cast("long").alias("__doc"), F.col(text_col).alias("__text"))
    found = texts.join(few(wanted), F.col("doc") == F.col("__doc")).select("cls", "__text").mapInArrow(run, schema)
    found = staged(found, "sets")
    if found.groupBy("cls").count().filter("count > 1").isEmpty():
        return found
    return staged(found.dropDuplicates(["cls"]), "sets")       # rows that stand in the table several times


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share `percent` hundredths of their union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = shared(x, y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def class_pairs(linked: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b) of different classes, a the smaller, for pairs (a, b) of ids."""
    of = rows.filter(F.col("cls").isNotNull() & F.col("doc").isNotNull())
    both = (linked.join(of.select(F.col("doc").alias("a"), F.col("cls").alias("x")), "a")
            .join(of.select(F.col("doc").alias("b"), F.col("cls").alias("y")), "b").filter("x <> y"))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach `percent` hundredths of similarity."""
    one = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
    two = one.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                keep.append(similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), percent))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return two.mapInArrow(run, PAIRS).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    region_rows: int = REGION_ROWS, linked: DataFrame | None = None) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, cls (equal for equal sets; null without words).

    `linked` gives pairs (a, b) of ids whose documents, if both have words, count as linked without being compared.
    """
    least = least_matches(percent / 100)
    rows = staged(shingled(docs, k, id_col, text_col), "shingled")
    nodes = staged(rows.filter(F.col("cls").isNotNull() & F.col("doc").isNotNull()).groupBy("cls", "key2")
                   .agg(F.min("doc").alias("doc"), F.first("sketch").alias("sketch")), "classes")
    found = regions(nodes, region_rows)
    first = staged(spanning_pairs(with_sketch(found.select(*KEY, "cls", F.col("cls").alias("comp"), F.lit(0).alias("side")), nodes), least), "first-pairs")

    touched = staged(first.select(F.col("a").alias("cls")).unionAll(first.select("b")).distinct(), "touched")
    todo = first
    if linked is not None:
        known = staged(class_pairs(linked, rows), "known-links")
        todo = staged(first.join(known, ["a", "b"], "left_anti"), "first-pairs")
    asked = staged(todo.select(F.col("a").alias("cls")).unionAll(todo.select("b")).distinct(), "asked")
    wanted = staged(nodes.join(few(asked), "cls", "left_semi").select("cls", "doc"), "wanted")
    sets = class_sets(docs, wanted, k, id_col, text_col)
    links = confirmed(todo, sets, percent)
    links = staged(links if linked is None else links.unionAll(known), "first-links")
    comps = staged(components(links), "components")

    # second round, over classes that some region's estimate brought near another one
    crossing = staged(second_rows(found, touched, comps, region_rows), "crossing-rows")
    again = staged(crossing.select("cls").distinct(), "asked")
    near = staged(nodes.join(few(again), "cls", "left_semi"), "crossing-classes")
    wanted = staged(near.select("cls", "doc").join(wanted, "cls", "left_anti"), "wanted")
    sets = sets.unionAll(class_sets(docs, wanted, k, id_col, text_col))
    more = staged(crossing_links(with_sketch(crossing, near, sets), least, percent), "second-links")
    comps = staged(components(links.unionAll(more)), "components")

    # the smallest id of each component
    labelled = (nodes.select(F.col("cls").alias("node"), "doc").join(comps, "node", "left")
                .select("node", "doc", F.coalesce("component", "node").alias("component")))
    least_doc = labelled.groupBy("component").agg(F.min("doc").alias("component_id"))
    of = labelled.join(least_doc, "component").select(F.col("node").alias("cls"), "component_id")
    out = rows.select("doc", "n", "cls").join(of, "cls", "left")
    component = F.coalesce("component_id", "doc")
    own = F.when(F.col("doc").isNotNull(), component)
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.coalesce(F.col("doc") == own, F.lit(True)).alias("kept"), "cls")
