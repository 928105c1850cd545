"""A corpus pipeline over `documents`, built from the operators of ``herdflow.llm``.

`STAGES` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns
what it keeps. `run` writes each stage's result as Parquet to the cluster's shared folder and
reads it back as the next stage's documents. All stages but the last return the columns of
`documents`, with n_chars following the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.llm import line_dedup, mixing, near_dup, packing, toxicity
from herdflow.llm.common import WORD_SQL, bound_batches, few, staged, table, work_tables
from herdflow.llm.queries import document_pieces


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 by the classifier learned from `labels` on this stage's input."""
    bound_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, threshold=0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that one with a smaller id holds; a document that loses its last word with
    them goes, one that had none stays as it is."""
    bound_batches(spark)
    has_word = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_SQL)) > 0
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], has_word.alias("__had")).alias("rest")
    kept = line_dedup.dedup_lines(docs.select("doc_id", "text", rest)).filter(has_word | ~F.col("rest.__had"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return kept.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, similarity of 0.8 or more.

    A row is judged by the text it has and, where that has changed, by the whole text that `documents` holds for its id
    too, if the id stands once in both: near copies by either text are one group, so lines that an earlier stage has cut
    neither hide copies that shared them nor keep rows apart that differed in them.
    Rows are told apart by a key of their own, so null, repeated and shared ids are documents like any other. The row with
    the smallest id stays, one with a null id only where there is no other; rows without words are copies of nothing.
    """
    bound_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = staged(docs.select(row, F.monotonically_increasing_id().alias("key")), "near-rows")
    keys = rows.select("key", F.col("row.doc_id").alias("id"))
    # an entry is a row's text as given (an even number) or its whole text (an odd one)
    entries, linked = rows.select((F.col("key") * 2).alias("entry"), F.col("row.text").alias("text")), None
    if sf_dir:
        texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
        changed = staged(_changed(rows.select(F.col("row.doc_id").alias("id"), "key", F.col("row.text").alias("text")), texts), "near-changed")
        whole = staged(texts.join(few(changed), "id").select((F.col("key") * 2 + 1).alias("entry"), "text"), "near-whole")
        entries = entries.unionAll(whole)
        linked = changed.select((F.col("key") * 2).alias("a"), (F.col("key") * 2 + 1).alias("b"))     # a row joins the groups of its two texts
    with work_tables(spark) as keep:
        found = near_dup.near_duplicates(entries, k=5, percent=80, id_col="entry", linked=linked)
        of = F.min(F.struct(F.col("cls").isNull(), "component_id")).alias("of")       # the group of the texts with words, if one has
        found = found.groupBy(F.shiftright("entry", 1).alias("key")).agg(of).select("key", F.col("of.component_id").alias("component"))
        group = keep(found.join(keys, "key"), "near-found")
    least = F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("least")
    kept = group.groupBy("component").agg(least, F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = staged(group.join(kept, "component").filter("key <> least.key").select("key"), "near-gone")
    return rows.join(few(gone), "key", "left_anti").select("row.*")


def _changed(given: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, key) of the ids that stand once in `given` (id, key, text) and once in `texts` (id, text), with another text."""
    both = given.unionAll(texts.select("id", F.lit(None).cast("long").alias("key"), "text")).filter("id IS NOT NULL")
    marks = both.select("id", "key", F.sha2(F.coalesce("text", F.lit("")), 256).alias("mark"))
    found = marks.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count("key").alias("n_given"), F.max("key").alias("key"),
                                    F.min("mark").alias("lo"), F.max("mark").alias("hi"))
    return found.filter("n = 2 AND n_given = 1 AND lo <> hi").select("id", "key")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights, a row for each time one is taken; the shards grow in number
    with the words drawn, and a shard's rows stand together in shuffled order."""
    plan = mixing.plan_mix(docs, weights=(5, 2, 1), share=1.5, cap=2.0)
    if plan is None:
        return docs
    return mixing.draw(docs, plan).repartition("shard").sortWithinPartitions("shard", "order").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of at most 2048 tokens."""
    return packing.pack(document_pieces(docs), capacity=2048)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_copies),
          ("mixing", mix), ("packing", pack)]

#: SQL cannot express the learned and hashed stages; tests hold them against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's rows over the whole `documents` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
