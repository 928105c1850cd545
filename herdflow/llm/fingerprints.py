"""Document fingerprints by invertible Bloom lookup sketches, in DataFrame and SQL functions only.

A text's paragraphs (its lines, and inside a line the sentences that begin with a letter of
`CUT_LETTERS`, so that long lines have parts too) become a set of 64-bit digests. A sketch has
cells of (count, xor of digests, xor of check sums); a digest goes to one cell in each third of
them. Sketches of two versions subtract cell by cell, which cancels what they share; peeling then
takes digests off cells that hold just one, until all cells are empty. The `BASE_CELLS` cells are
the fingerprint. Where peeling it fails, the pair is sketched anew, larger: the digests are split
by hash into groups of about `GROUP_KEYS`, each with a sketch of `GROUP_CELLS` cells, and groups
that still fail are tried again with three times as many cells until none is left. The digests
recovered give the likeness: shared / all paragraphs.

`versions` puts each document beside the one that follows it in an order: ids are dealt to ranges
(one row per range reaches the driver), and a range also gets a copy of the row that follows its
last one, so that texts move once.

Cases: a null or empty text has no paragraphs; two texts without paragraphs have likeness 1; null ids
come last; rows with an equal id follow in order of their texts' hashes; a lone row follows itself;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdflow.llm.common import staged

CUT_LETTERS = "A-M"
BASE_CELLS = 12
GROUP_CELLS = 24
GROUP_KEYS = 10
ROUNDS = 12
RANGE_ROWS = 2000
MAX_RANGES = 8192

CELL = "struct<n:int,k:bigint,h:bigint>"


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    parts = F.split(F.coalesce(text, F.lit("")), rf"\n|(?<=[.!?] )(?=[{CUT_LETTERS}])", -1)
    return F.array_distinct(F.transform(F.filter(parts, lambda p: F.trim(p) != ""), lambda p: F.xxhash64(p)))


def placed(keys: str, cells: int) -> str:
    """SQL: digests with their check sum and their cell in each third."""
    w = cells // 3
    at = ", ".join(f"int({r * w} + pmod(shiftrightunsigned(k, {20 * r}) & 1048575, {w})) AS p{r}" for r in range(3))
    return f"transform({keys}, k -> struct(k AS k, xxhash64(k) & 4294967295 AS h, {at}))"


def sketch(keys: str, cells: int) -> str:
    """SQL: the cells of a set of digests."""
    return f"""transform(array({placed(keys, cells)}), ps -> transform(sequence(0, {cells - 1}), i ->
        aggregate(filter(ps, p -> p.p0 = i OR p.p1 = i OR p.p2 = i), CAST(struct(0, 0L, 0L) AS {CELL}),
                  (a, p) -> CAST(struct(a.n + 1, a.k ^ p.k, a.h ^ p.h) AS {CELL}))))[0]"""


def subtract(a: str, b: str) -> str:
    """SQL: one sketch less another."""
    return f"zip_with({a}, {b}, (x, y) -> CAST(struct(x.n - y.n, x.k ^ y.k, x.h ^ y.h) AS {CELL}))"


def pure(cells: str, n: int) -> str:
    """SQL: the digests of the cells that hold just one, with their sign and their cells."""
    w = n // 3
    at = ", ".join(f"int({r * w} + pmod(shiftrightunsigned(c.k, {20 * r}) & 1048575, {w})) AS p{r}" for r in range(3))
    return (f"array_distinct(transform(filter({cells}, c -> (c.n = 1 OR c.n = -1) AND (xxhash64(c.k) & 4294967295) = c.h), "
            f"c -> struct(c.n AS s, c.k AS k, c.h AS h, {at})))")


def peel(cells: str, n: int) -> str:
    """SQL: struct of `left` (cells after peeling) and `found` (sign and digest of each digest taken off)."""
    found = "array<struct<s:int,k:bigint>>"
    step = f"""if(size(s.pure) = 0, s, transform(array(transform(s.left, (c, i) ->
        aggregate(filter(s.pure, p -> p.p0 = i OR p.p1 = i OR p.p2 = i), c,
                  (a, p) -> CAST(struct(a.n - p.s, a.k ^ p.k, a.h ^ p.h) AS {CELL})))),
        cs -> struct(cs AS left, {pure('cs', n)} AS pure,
                     concat(s.found, transform(s.pure, p -> struct(p.s AS s, p.k AS k))) AS found))[0])"""
    return f"""transform(array({cells}), c0 -> aggregate(sequence(1, {ROUNDS}),
        struct(c0 AS left, {pure('c0', n)} AS pure, CAST(array() AS {found}) AS found), (s, r) -> {step}))[0]"""


def emptied(left: str) -> str:
    """SQL: whether nothing is left in any cell."""
    return f"forall({left}, c -> c.n = 0 AND c.k = 0 AND c.h = 0)"


def as_text(n_chars: str, text_hash: str, cells: str) -> str:
    """SQL: a fingerprint as text: length, hash of the whole text, cells."""
    body = "array_join(transform(%s, c -> concat(lpad(hex(c.n), 4, '0'), lpad(hex(c.k), 16, '0'), lpad(hex(c.h), 8, '0'))), '')"
    return f"concat({n_chars}, ':', lpad(hex({text_hash}), 16, '0'), ':', {body % cells})"


def recovered(pairs: DataFrame) -> DataFrame:
    """(id, found) with signs and digests of what differs, a row a group, for rows of (id, a, b), digest sets of two versions.

    Groups of digests are sketched, subtracted and peeled; failures go on to larger sketches.
    """
    groups = F.greatest(F.lit(1), F.ceil((F.size("a") + F.size("b")) / GROUP_KEYS)).cast("int")
    own = "filter({0}, k -> pmod(shiftright(k, 7) ^ xxhash64(k), g) = grp) AS {0}"
    todo = (pairs.withColumn("g", groups).withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
            .selectExpr("id", "grp", own.format("a"), own.format("b")))
    cells, done = GROUP_CELLS, []
    while True:
        diff = subtract(sketch("a", cells), sketch("b", cells))
        tried = todo.withColumn("peeled", F.expr(peel(diff, cells)))
        tried = tried.withColumn("ok", F.expr(emptied("peeled.left")))
        # the digests recovered of the groups that peel, the digests of those that don't
        tried = staged(tried.selectExpr("id", "grp", "if(ok, NULL, a) AS a", "if(ok, NULL, b) AS b", "ok", "if(ok, peeled.found, NULL) AS found"), "peeled")
        done.append(tried.filter("ok").select("id", "found"))
        todo = tried.filter("NOT ok").select("id", "grp", "a", "b")
        if todo.isEmpty():
            break
        cells *= 3
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return out


def differences(pairs: DataFrame) -> DataFrame:
    """(id, only_a, only_b) arrays of digests for rows of (id, a, b), digest sets of two versions."""
    out = recovered(pairs)
    side = "transform(filter(found, f -> f.s = {0}), f -> f.k)"
    return out.groupBy("id").agg(F.flatten(F.collect_list(F.expr(side.format(1)))).alias("only_a"),
                                 F.flatten(F.collect_list(F.expr(side.format(-1)))).alias("only_b"))


def likeness(a: str, b: str, d: str) -> str:
    """SQL: shared / all paragraphs, from the sets' sizes and the number that differ."""
    return f"CASE WHEN {a} + {b} + {d} = 0 THEN 1D ELSE ({a} + {b} - {d}) / CAST({a} + {b} + {d} AS DOUBLE) END"


def ranges(docs: DataFrame, id_col: str) -> list[tuple[int, int]]:
    """(smallest, largest) id of consecutive ranges of about RANGE_ROWS rows."""
    ids = docs.select(F.col(id_col).cast("long").alias("id")).filter("id IS NOT NULL")
    n = max(1, min(MAX_RANGES, -(-ids.count() // RANGE_ROWS)))
    got = (ids.repartitionByRange(n, "id").groupBy(F.spark_partition_id()).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
           .select("lo", "hi").collect())                      # a row per range
    return sorted((r.lo, r.hi) for r in got)


def versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and next (the text that follows in descending order of ids; the first after the last)."""
    spans = ranges(docs, id_col) or [(0, 0)]
    n = len(spans)
    fixed = lambda xs: f"CAST(split('{','.join(map(str, xs))}', ',') AS ARRAY<BIGINT>)"
    steps = max(1, (n - 1).bit_length())
    # binary search for the last range that begins at or below the id
    search = f"""aggregate(sequence(1, {steps}), struct(0 AS lo, {n} AS hi), (s, r) ->
        if({fixed([a for a, _ in spans])}[(s.lo + s.hi) div 2] <= id, struct(int((s.lo + s.hi) div 2) AS lo, s.hi AS hi),
           struct(s.lo AS lo, int((s.lo + s.hi) div 2) AS hi))).lo"""
    rows = docs.select(F.col(id_col).alias("given"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.when(F.col("id").isNull(), 0).otherwise(F.expr(search)))
    # the largest id of a range follows the smallest of the range above it
    follows = f"if(id = {fixed([b for _, b in spans])}[at], array(struct(at AS part, 0 AS copy), struct(int((at + 1) % {n}) AS part, 1 AS copy)), array(struct(at AS part, 0 AS copy)))"
    rows = rows.select("given", "id", "text", F.explode(F.expr(f"coalesce({follows}, array(struct(at AS part, 0 AS copy)))")).alias("p"))
    order = Window.partitionBy("p.part").orderBy("p.copy", F.desc_nulls_last("id"), F.xxhash64("text"))
    return (rows.withColumn("next", F.coalesce(F.lead("text").over(order), F.lit(""))).filter("p.copy = 0")
            .select(F.col("given").alias("id"), "text", "next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the document with its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the document that follows in descending order of ids.
    """
    v = versions(docs, id_col, text_col)
    v = v.withColumn("n_chars", F.length("text").cast("long"))
    half = "int(n_chars div 2)"
    v = v.withColumn("edited", F.expr(f"concat(substring(text, 1, int(n_chars) - {half}), substring(next, 1, {half}))"))
    v = v.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("text").alias("th"),
                 F.length("edited").alias("n_edited"), F.xxhash64("edited").alias("eh"), digests(F.col("text")).alias("own"),
                 digests(F.col("edited")).alias("other"), digests(F.col("next")).alias("following"))
    v = v.withColumns({"row": F.monotonically_increasing_id()})
    v = staged(v, "versions")
    cells = v.withColumns({x: F.expr(sketch(y, BASE_CELLS)) for x, y in (("co", "own"), ("ce", "other"), ("cn", "following"))})
    peeled = cells.withColumns({
        "pe": F.expr(peel(subtract("co", "ce"), BASE_CELLS)), "pn": F.expr(peel(subtract("co", "cn"), BASE_CELLS)),
        "fingerprint": F.expr(as_text("n_chars", "th", "co")), "edited_fingerprint": F.expr(as_text("n_edited", "eh", "ce"))})
    count = lambda p: f"if({emptied(p + '.left')}, size({p}.found), NULL)"
    base = staged(peeled.selectExpr("row", "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "size(own) AS a",
                                    "size(other) AS b", "size(following) AS c", f"{count('pe')} AS de", f"{count('pn')} AS dn"), "fingerprints")
    # pairs whose fingerprints don't peel are sketched larger
    failed = base.filter("de IS NULL OR dn IS NULL").select("row", "de", "dn").join(v.select("row", "own", "other", "following"), "row")
    pairs = failed.select("row", F.explode(F.expr(
        "filter(array(if(de IS NULL, struct('e' AS kind, own AS a, other AS b), NULL), if(dn IS NULL, struct('n' AS kind, own AS a, following AS b), NULL)), p -> p IS NOT NULL)")).alias("p"))
    found = recovered(pairs.select(F.struct("row", "p.kind").alias("id"), "p.a", "p.b"))
    found = found.select("id.row", "id.kind", F.size("found").alias("d"))
    found = found.groupBy("row").agg(F.sum(F.expr("if(kind = 'e', d, NULL)")).alias("fe"), F.sum(F.expr("if(kind = 'n', d, NULL)")).alias("fn"))
    out = base.join(found, "row", "left")
    return out.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      F.expr(likeness("a", "b", "coalesce(de, fe)")).alias("near_edited"),
                      F.expr(likeness("a", "c", "coalesce(dn, fn)")).alias("near_next"))
