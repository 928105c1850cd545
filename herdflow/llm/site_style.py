"""Main text of web pages by site style trees.

1. Every page's elements are read into blocks of text, each under its path of elements and classes,
   and containers with the kinds of their children. The paths of all pages of a host form the host's
   style tree.
2. A content node's importance is the mean over its distinct texts of 1 - H, H the entropy of the
   text's spread over the host's m distinct pages (log base m): 0 for texts that stand on all pages, 1
   for texts of one page. Pages of a host with the same paths and texts (outside what 4 leaves out by
   name) are copies and count as one. A presentation node's importance is the entropy of its children's kinds. A
   path counts `CONTENT_SHARE` its content, the rest its container's presentation.
3. The same is done for the paths over the distinct pages of all hosts together, which stands in where
   a host has fewer than `FEW_PAGES` distinct pages: else the smaller of the two counts, inside article
   elements the larger.
4. Branches below `least` are cut from each page of the host. Kinds and names of elements (menu, header, footer,
   sidebar, notice, advert, form, comment) are hints about what stands beside the article: they never cut an article
   or main element or what holds it. Scripts, styles and the like have no text. The rest is the text: blocks in page order.

Counts are aggregated by (host, page hash, path, text hash) and then by (host, path, text hash), so a
host with a third of all pages is spread by its texts. Pages are read twice and never collected by host.

Cases: a null or empty html has the empty text; a null url is a host of its own; a page whose host
has one page goes by the paths over all hosts; broken markup is closed where HTML would; repeated
rows and copies count as one page; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.llm.common import staged
from herdflow.llm.markup import Page, features, hash64

CONTENT_SHARE = 0.9
#: Distinct pages of a host from which its own entropy counts outside article elements.
FEW_PAGES = 4
#: The kind of the row that stands for a page itself.
PAGE = 2


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def observed(pages: DataFrame) -> DataFrame:
    """(host, path, parent, kind, feature, article, page) for each page's features, and a row of kind `PAGE`.

    `page` is a hash of the page's features: copies have the same.
    """
    schema = "host string, path long, parent long, kind int, feature long, article boolean, page long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for h, html in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                page = Page(html.as_py() or "")
                found = sorted(features(page))
                key = hash64(repr(found))
                for path, kind, feature, article in [*found, (0, PAGE, 0, False)]:
                    for c, v in zip(cols, (h, path, page.parents.get(path, 0), kind, feature, article, key), strict=True):
                        c.append(v)
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["host", "path", "parent", "kind", "feature", "article", "page"])

    return pages.select("host", "html").mapInArrow(run, schema)


def importance(seen: DataFrame, pages: DataFrame | int, by: list[str], name: str) -> DataFrame:
    """(by, path, article, m, name): the importance of each content path.

    `seen` has the features of each distinct page once; `pages` is the number of distinct pages m, by
    host or of all.
    """
    c = seen.groupBy(*by, "path", "kind", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.max("article").alias("article"), F.max("parent").alias("parent"))
    if by:
        c = c.join(F.broadcast(pages) if pages.count() <= 100_000 else pages, by)
    else:
        c = c.withColumn("m", F.lit(pages).cast("long"))
    log = F.log("n") / F.log(F.greatest("m", F.lit(2)))
    content = (c.filter("kind = 0").groupBy(*by, "path", "m")
               .agg(F.avg(F.when(F.col("m") > 1, 1 - F.least(log, F.lit(1.0)))).alias("content"),
                    F.max("article").alias("article"), F.max("parent").alias("parent")))
    shown = c.filter("kind = 1").groupBy(*by, "path", "m").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = (F.log("all") - F.col("nlogn") / F.col("all")) / F.log(F.greatest("m", F.lit(2)))
    shown = shown.select(*by, F.col("path").alias("parent"), F.least(F.greatest(entropy, F.lit(0.0)), F.lit(1.0)).alias("shown"))
    both = content.join(shown, [*by, "parent"], "left")
    value = CONTENT_SHARE * F.col("content") + (1 - CONTENT_SHARE) * F.coalesce("shown", F.lit(0.0))
    return both.select(*by, "path", "article", "m", value.alias(name))


def distinct_pages(rows: DataFrame, by: list[str]) -> DataFrame:
    """Features of each distinct page once, with (by, page) as what tells pages apart."""
    return rows.groupBy(*by, "page", "path", "kind", "feature").agg(
        F.max("article").alias("article"), F.max("parent").alias("parent"))


def cut_paths(pages: DataFrame, least: float) -> DataFrame:
    """(host, cut): the paths of each host whose branches are cut."""
    seen = staged(distinct_pages(observed(pages), ["host"]), "style-pages")
    marks, seen = seen.filter(F.col("kind") == PAGE), seen.filter(F.col("kind") != PAGE)
    m = staged(marks.groupBy("host").agg(F.count(F.lit(1)).alias("m")), "host-pages")
    own = importance(seen, m, ["host"], "own")
    total = marks.select("page").distinct().count()
    all_ = importance(distinct_pages(seen, []), total, [], "general").select("path", "general")
    both = own.join(all_, "path")
    value = (F.when(F.col("article"), F.greatest("own", "general")).when(F.col("m") < FEW_PAGES, F.col("general"))
             .otherwise(F.least("own", "general")))
    low = both.filter(F.coalesce(value, F.lit(1.0)) < least)
    return low.groupBy("host").agg(F.collect_set("path").alias("cut"))


def main_text(pages: DataFrame, least: float = 0.5, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Per page: id, url, text, n_chars (code points)."""
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"),
                       F.col(html_col).alias("html"))
    cuts = staged(cut_paths(own, least), "style-cuts")
    schema = T.StructType([T.StructField(id_col, pages.schema[id_col].dataType), T.StructField(url_col, T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for html, cut in zip(b.column(2), b.column(3).to_pylist(), strict=True):
                cut = set(cut or ())
                blocks = Page(html.as_py() or "").blocks
                out.append("\n\n".join(t for p, _, t in blocks if p not in cut))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())], names=schema.names)

    return own.join(cuts, "host", "left").select("id", "url", "html", "cut").mapInArrow(run, schema)
