"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every row gets its size in words and a hash `h` that permutes rows; the low part of the hash
   deals a source's rows into at most `BUCKETS` blocks, so no source is ever gathered whole. `h` is of id, source,
   text and a number among rows that share all three, so rows of one id (or of none) are drawn each by itself.
2. Targets come from the per-source totals (one row per source): the shared total is divided
   by weight, a target stops at `cap` times its source, and the excess is shared again.
3. A source's blocks stand in a permuted order; whole passes and the blocks up to the rest of the
   target are drawn, and the last block is cut at a value of `h`, so the words taken are within
   about one document of the target. A row's number of copies is thus a function of
   (source, block, h) alone, and reruns agree.
4. The splitting tree deals the exact block quotas of all sources among the shards: a node of k
   shards draws its left half's quotas from a multivariate hypergeometric distribution, down to
   single shards, each of which gets a run of every source's permuted block list. Runs are
   disjoint. Inside a shard rows are ordered by a hash (the local shuffle).

Cases: a null text has size 0; null sources form one source, ordered last; a source without words
has target 0 and nothing is taken; repeated rows are drawn each by itself; an empty table gives an empty
result; other columns, whatever their names, are kept only by `draw`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdflow.llm.common import WORD_SQL, staged

BUCKETS = 4096


@dataclass
class Mix:
    """What `plan_mix` settles: sizes per row, and the drawn blocks with their shards."""

    rows: DataFrame      # id, source, size, __h, __block (one row a document)
    sources: DataFrame   # source, source_size, target
    blocks: DataFrame    # source, block, copies, extra, cut, shards
    groups: DataFrame | None   # rows that share id, source and text, if there are any


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_SQL)).cast("long")


def fill(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Targets by weight that stop at `cap` times their size; the excess is shared again."""
    target = [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    left = total
    while open_:
        per = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if per * weights[i] > cap * sizes[i]}
        if not over:
            for i in open_:
                target[i] = per * weights[i]
            break
        for i in over:
            target[i] = cap * sizes[i]
            left -= target[i]
        open_ -= over
    return target


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Quotas of every shard (shards x sources); the columns add up to `quotas`."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def go(lo: int, hi: int, q: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = q
            return
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        n = int(q.sum())
        take = n * (mid - lo) // (hi - lo)
        left = rng.multivariate_hypergeometric(q, take, method="marginals") if n else q * 0
        go(lo, mid, left)
        go(mid, hi, q - left)

    go(0, shards, np.asarray(quotas, np.int64))
    return out


def same_rows(rows: DataFrame) -> DataFrame:
    """(id, source, th, m): the groups of m > 1 rows that share id, source and text hash."""
    return rows.groupBy("id", "source", "th").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")


def _same(a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ("id", "source", "th")])


def numbered(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """`rows` (with id, source, th) plus `nth`: 0, 1, 2... among rows that share all three; `groups` are those of
    `same_rows`, None if there are none.

    Which of such rows gets which number is open, so they are numbered where they are: inside each partition, on from
    the number of them in the partitions before. A group may fill any number of partitions.
    """
    if groups is None:
        return rows.withColumn("nth", F.lit(0).cast("long"))
    single = rows.alias("r").join(groups.alias("g"), _same("r", "g"), "left_anti").withColumn("nth", F.lit(0).cast("long"))
    several = rows.alias("r").join(groups.alias("g"), _same("r", "g"), "left_semi").select("r.*")
    several = staged(several.withColumns({"pid": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "mix-repeats")
    before = several.groupBy("id", "source", "th", "pid").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("id", "source", "th").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = before.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))      # a row a group and partition
    local = F.row_number().over(Window.partitionBy("id", "source", "th", "pid").orderBy("at")) - 1
    placed = several.withColumn("local", local).alias("a").join(before.alias("b"), _same("a", "b") & (F.col("a.pid") == F.col("b.pid")))
    return single.unionByName(placed.select("a.*", (F.col("a.local") + F.col("b.before")).alias("nth")).drop("pid", "at", "local"))


def hashed(rows: DataFrame, groups: DataFrame | None, seed: int) -> DataFrame:
    """`numbered` rows with `h`, which permutes them each by itself, and `block`."""
    h = F.xxhash64(F.lit(seed), F.col("id").isNull(), "id", F.col("source").isNull(), "source", "th", "nth")
    return numbered(rows, groups).withColumn("h", h).withColumn("block", F.pmod("h", F.lit(BUCKETS)).cast("int"))


def keyed(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> list[Column]:
    """id, source, th (a hash of the text) and size of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("th"),
            word_count(F.col(text_col)).alias("size")]


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
             shards: int = 64, shard_words: int = 20_000_000, seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text") -> Mix | None:
    """Settle targets, drawn blocks and shards (`shards`, or more of about `shard_words` words); None for an empty table."""
    spark = docs.sparkSession
    small = staged(docs.select(*keyed(docs, id_col, source_col, text_col)), "mix-sizes")
    groups = staged(same_rows(small), "mix-groups")
    groups = None if groups.isEmpty() else groups
    rows = staged(hashed(small, groups, seed).select("id", "source", "size", F.col("h").alias("__h"), F.col("block").alias("__block")), "mix-rows")
    found = rows.groupBy("source").agg(F.sum("size").alias("n")).collect()   # one row per source
    if not found:
        return None
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.n for r in found]
    target = fill(sizes, [weights[i % len(weights)] for i in range(len(found))], share * sum(sizes), cap)
    shards = max(shards, -(-int(sum(target)) // shard_words))
    passes = [min(int(cap), int(t // n)) if n else 0 for t, n in zip(target, sizes, strict=True)]
    rest = [t - p * n for t, p, n in zip(target, passes, sizes, strict=True)]
    sources = spark.createDataFrame(
        [(r.source, n, t, p, x) for r, n, t, p, x in zip(found, sizes, target, passes, rest, strict=True)],
        "source string, source_size long, target double, passes int, rest double")

    # blocks in permuted order, with the words before each
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), F.col("source"), F.col("__block")), "__block")
    blocks = (rows.groupBy("source", "__block").agg(F.sum("size").alias("words"))
              .withColumn("place", F.row_number().over(order) - 1)
              .withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
              .select("b.source", F.col("__block").alias("block"), "words", "place", "upto", "passes", "rest"))
    whole = F.col("upto") <= F.col("rest")
    part = ~whole & (F.col("upto") - F.col("words") < F.col("rest"))
    blocks = staged(blocks.select("source", "block", "place", "passes", whole.cast("int").alias("extra"),
                                  part.alias("part"), (F.col("rest") - (F.col("upto") - F.col("words"))).alias("room")),
                    "mix-blocks")

    # the block that the rest of a target ends in is cut at a value of h
    cut_rows = (rows.alias("r").join(blocks.filter("part").alias("b"),
                                     F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.__block") == F.col("b.block")))
                .groupBy("b.source", "b.block", "r.__h").agg(F.sum("r.size").alias("size"), F.first("b.room").alias("room")))
    by_h = Window.partitionBy("source", "block").orderBy("__h").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (cut_rows.withColumn("upto", F.sum("size").over(by_h))
            .filter(F.col("upto") - F.col("size") / 2 <= F.col("room"))   # nearer with it than without
            .groupBy("source", "block").agg(F.max("__h").alias("cut")))

    # block quotas, dealt among the shards by the splitting tree
    drawn = blocks.groupBy("source").agg(F.sum(F.col("passes") + F.col("extra") + F.col("part").cast("int")).alias("n"))
    quota = {r.source: r.n for r in drawn.collect()}                        # one row per source
    ends = np.cumsum(split_quotas(np.array([quota[r.source] for r in found]), shards, seed), axis=0)
    runs = spark.createDataFrame([(r.source, ends[:, i].tolist()) for i, r in enumerate(found)],
                                 "source string, ends array<long>")
    n_blocks = F.count(F.lit(1)).over(Window.partitionBy("b.source"))
    copies = F.col("passes") + F.col("extra") + F.col("part").cast("int")
    listed = (blocks.alias("b").join(cuts.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source"))
                                     & (F.col("b.block") == F.col("c.block")), "left")
              .join(runs.alias("q"), F.col("b.source").eqNullSafe(F.col("q.source")))
              .select("b.source", "b.block", "passes", "extra", "cut", copies.alias("listed"),
                      n_blocks.alias("n"), "place", "ends"))
    shard = F.when(F.col("listed") > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("listed"), F.lit(1)) - 1),
        lambda c: F.size(F.filter("ends", lambda e: e <= c * F.col("n") + F.col("place")))))
    listed = listed.select("source", "block", (F.col("passes") + F.col("extra")).alias("copies"), "cut",
                           F.coalesce(shard, F.array().cast("array<int>")).alias("shards"))
    return Mix(rows, sources, listed, groups)


def with_copies(rows: DataFrame, mix: Mix, source: str = "source") -> DataFrame:
    """`rows` (with __h and __block) plus `__copies` and `__shards` (one shard per copy)."""
    b = mix.blocks.select(F.col("source").alias("__source"), F.col("block").alias("__b"),
                          F.col("copies").alias("__whole"), F.col("cut").alias("__cut"), F.col("shards").alias("__listed"))
    cond = F.col(source).cast("string").eqNullSafe(F.col("__source")) & (F.col("__block") == F.col("__b"))
    copies = F.col("__whole") + F.coalesce((F.col("__h") <= F.col("__cut")).cast("int"), F.lit(0))
    return (rows.join(b, cond).withColumn("__copies", copies)
            .withColumn("__shards", F.slice("__listed", F.lit(1), F.col("__copies")))
            .drop("__source", "__b", "__whole", "__cut", "__listed"))


def mix_report(mix: Mix) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken, copies and the shard of each."""
    rows = with_copies(mix.rows, mix)
    s = mix.sources.select(F.col("source").alias("__s"), "source_size", "target")
    return (rows.join(F.broadcast(s) if _few(s) else s, F.col("source").eqNullSafe(F.col("__s")))
            .select("id", "source", "size", "source_size", "target",
                    (F.col("size") * F.col("__copies")).alias("taken"), F.col("__copies").alias("copies"),
                    F.col("__shards").alias("shards")))


def _few(sources: DataFrame, most: int = 100_000) -> bool:
    """Whether the table of sources is small enough to send to every executor."""
    return sources.count() <= most


def draw(docs: DataFrame, mix: Mix, seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
         text_col: str = "text") -> DataFrame:
    """(row, shard, order): the mixed rows, a row for each copy; `row` is a struct of all columns of `docs`."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = hashed(docs.select(row, *keyed(docs, id_col, source_col, text_col)), mix.groups, seed)
    rows = with_copies(rows.select("row", "source", F.col("h").alias("__h"), F.col("block").alias("__block")), mix)
    return (rows.select("row", "__h", F.posexplode("__shards").alias("copy", "shard"))
            .select("row", "shard", F.xxhash64(F.lit(seed + 2), "__h", "copy").alias("order")))
