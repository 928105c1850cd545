"""Nearest neighbours by inner product: a robust-pruned graph per shard, beam search in each.

1. Rows with equal vectors form one class (a vector may be shared by a third of all rows); the
   graph holds one point per class, and a class answers with its smallest ids.
2. Classes are dealt to shards by a hash of the vector, at most about `shard_rows` to a shard, so
   a shard's points fit a task. There are at least `MIN_SHARDS` shards.
3. Each shard's task builds its graph (see ``vector_graph``) and beam-searches it for a slice of
   the query vectors; found points are scored anew in double precision on the original vectors.
4. The shards' answers are merged by rank, then classes are expanded to rows.

The index covers every row; answers are approximate, ranks and scores of what is found are exact.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor
do null ids; vectors only meet vectors of their own length; equal scores go by the smaller id; a
repeated id counts once per vector; a query with fewer candidates gets all found; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdflow.llm.common import staged
from herdflow.llm.vector_graph import Graph

MIN_SHARDS = 8
#: Query vectors that one task searches a shard for.
SLICE_ROWS = 200_000

FOUND = "q1 long, q2 long, c1 long, c2 long, score double"


def usable(vec: Column) -> Column:
    """Not null or empty, all components finite, not all of them zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vec, lambda x: x != 0)


def matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(pa.concat_arrays(col.chunks).flatten()).reshape(-1, dim) if len(col) else np.zeros((0, dim))


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            degree: int = 32, build_beam: int = 64, beam: int = 192, shard_rows: int = 50_000) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query row, itself excluded."""
    vec = F.col(vec_col).cast("array<double>")
    good = rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), is_query.alias("query"))
    good = good.filter(F.col("id").isNotNull() & usable(F.col("vec"))).dropDuplicates(["id", "vec"])
    keyed = staged(good.withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit("second"), "vec")}), "vectors")
    n = keyed.count()

    # a class's smallest ids: itself may be a query, so one more than k
    rank = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("id"))
    members = staged(keyed.withColumn("rank", rank).filter(F.col("rank") <= k + 1), "members")
    shards = max(MIN_SHARDS, -(-n // shard_rows))
    points = members.filter("rank = 1").select(
        "k1", "k2", "vec", F.size("vec").alias("dim"), F.pmod("k1", F.lit(shards)).cast("int").alias("shard"))
    queries = keyed.filter("query").groupBy("k1", "k2").agg(F.first("vec").alias("vec"))
    slices = max(1, -(-n // (20 * SLICE_ROWS)))
    slice_of = F.pmod("k2", F.lit(slices)).cast("int")
    asked = queries.select("k1", "k2", "vec", F.size("vec").alias("dim"), slice_of.alias("slice"),
                           F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    held = points.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def search(key: tuple, p: pa.Table, q: pa.Table) -> pa.Table:
        names = ["q1", "q2", "c1", "c2", "score"]
        if not p.num_rows or not q.num_rows:
            return pa.table({c: pa.array([], pa.float64() if c == "score" else pa.int64()) for c in names})
        dim = key[0].as_py()
        p = p.sort_by([("k1", "ascending"), ("k2", "ascending")])
        x, y = matrix(p["vec"], dim), matrix(q["vec"], dim)
        found = Graph(x, degree, build_beam).nearest(y, min(beam, len(x)))
        at, to = np.nonzero(found >= 0)
        to = found[at, to]
        score = np.concatenate([np.einsum("id,id->i", y[at[i:i + 65536]], x[to[i:i + 65536]])
                                for i in range(0, len(at), 65536)])
        # the best k + 1 of each query vector (with all that tie), one of them may be its own class
        order = np.lexsort((-score, at))
        at, to, score = at[order], to[order], score[order]
        first = np.searchsorted(at, at)
        place = np.arange(len(at)) - first
        last = score[np.minimum(first + k, np.searchsorted(at, at, "right") - 1)]
        keep = (place <= k) | (score >= last)
        cols = [np.asarray(t[c])[i[keep]] for t, i in ((q, at), (p, to)) for c in ("k1", "k2")]
        return pa.table(dict(zip(names, [*cols, score[keep]], strict=True)))

    found = staged(held.groupBy("dim", "shard", "slice").cogroup(asked.groupBy("dim", "shard", "slice"))
                   .applyInArrow(search, FOUND), "found")

    # best classes of each query vector over all shards, by score and smallest member
    smallest = members.filter("rank = 1").select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("id").alias("least"))
    by = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    classes = (found.join(smallest, ["c1", "c2"]).withColumn("r", F.row_number().over(by)).filter(F.col("r") <= k + 1)
               .drop("r", "least"))
    answer = classes.join(members.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("id").alias("vec_id")),
                          ["c1", "c2"])
    # k + 1 rows answer every query with this vector
    top = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    answer = answer.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k + 1).select("q1", "q2", "vec_id", "score")
    ask = keyed.filter("query").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("id").alias("query_id"))
    own = Window.partitionBy("query_id", "q1", "q2").orderBy(F.desc("score"), "vec_id")
    return (ask.join(answer, ["q1", "q2"]).filter(F.col("query_id") != F.col("vec_id"))
            .withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
