"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdflow.llm import (fingerprints, lexical_search, licenses, line_dedup, mixing, near_dup, nearest, packing, quality_rules,
                          resampling, site_style, toxicity)
from herdflow.llm import token_counts as tc
from herdflow.llm.common import table

BYTE_BPE = "byte_bpe_50k.json"
#: The same vocabulary as a ranks file, and its special string.
BYTE_BPE_RANKS, BYTE_BPE_SPECIAL = "byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256}


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the byte-level vocabulary."""
    return tc.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(document_pieces(table(spark, sf_dir, "documents")), capacity=2048)


def document_pieces(docs: DataFrame) -> DataFrame:
    """The documents' pieces of at most 2048 ids by the byte-level vocabulary, end id 0."""
    return packing.pieces(docs, public_tokenizers.path(BYTE_BPE_RANKS), BYTE_BPE_SPECIAL, capacity=2048, end_id=0)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return site_style.main_text(table(spark, sf_dir, "pages"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over all documents: four-word shingles, similarity of 0.8 or more."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80).drop("cls")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices that the documents hold."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds, dropped from every document."""
    return line_dedup.line_report(table(spark, sf_dir, "documents")).drop("keep_bitmap")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1 and 150% of all words."""
    docs = table(spark, sf_dir, "documents")
    mix = mixing.plan_mix(docs, weights=(5, 2, 1), share=1.5, cap=2.0)
    if mix is None:
        return docs.selectExpr("doc_id", "0L size", "0L source_size", "0D target", "0L taken")
    return mixing.mix_report(mix).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
                                         "copies", "shards")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every vector whose id is divisible by 20."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight for the benchmark's words, and its rank if it is among the 10% drawn."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the quality rules for every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for the text of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_main_text": op5_main_text,
    "op6_near_dedup": op6_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_mix_sources": op9_mix_sources,
    "op10_nearest": op10_nearest,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_quality_rules": op12_quality_rules,
    "op13_lexical_search": op13_lexical_search,
}

#: Lines as the contract splits and keys them; white space and letters are ASCII only.
_LINE_SQL = """
WITH lines AS (
  SELECT doc_id, n_lines, pos, parts[pos] AS line,
         translate(regexp_replace(parts[pos], '^[ \\x09-\\x0D]+|[ \\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM (SELECT doc_id, len(parts) AS n_lines, parts, unnest(range(1, len(parts) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), firsts AS (
  SELECT line_key, min(doc_id) AS first_doc FROM lines WHERE length(line_key) >= 10
  GROUP BY line_key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT l.*, coalesce(l.doc_id <> f.first_doc, false) AS dropped FROM lines l LEFT JOIN firsts f USING (line_key)
)
SELECT doc_id, CAST(max(n_lines) AS BIGINT) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: All pairs that share a shingle, and the components of the links.
_NEAR_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(4, len(w)) - 1), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.doc_id
)
SELECT r.doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""

ORACLE_SQL: dict[str, str] = {"op6_near_dedup": _NEAR_SQL, "op7_license_scan": licenses.scan_sql(), "op8_line_dedup": _LINE_SQL,
                              "op11_importance_resampling": resampling.resample_sql(),
                              "op12_quality_rules": quality_rules.judge_sql(),
                              "op13_lexical_search": lexical_search.search_sql()}
