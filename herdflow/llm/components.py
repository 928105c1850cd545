"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdflow.llm.common import staged


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node each linked node reaches. `links` has long a, b.

    Every round is written to the shared folder; the driver sees one row of sums a round.
    """
    e = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        # large star: larger neighbours point to the smallest of the neighbourhood
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself point to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = staged(small, "stars")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
