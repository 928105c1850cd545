"""Licence notices in documents, in DataFrame and SQL functions only.

Words are runs of ASCII letters and digits, in lower case; a shingle is five of them (a notice of
fewer words is one shingle of its own length). Notices are grouped into classes by their number of
shingles, a power of two at most. For each class a text is cut into overlapping windows of
size + stride - 1 shingles, a quarter of the size apart, so that some window holds any copy whole.

1. A window's MinHash signature has one value a band; a notice is retrieved where any band agrees.
   `bands` gives the number of bands that finds a notice of containment `least` with a chance of
   0.9999 or more, by the smallest similarity such a window can have.
2. A band agrees only where the window holds the shingle behind the notice's minimum. So documents
   and windows without any such shingle are passed over before signatures are made; this changes
   no result.
3. A retrieved notice counts if the window holds at least `least` of its shingles, exactly.

Nothing is shuffled but the matches; the notices are a parameter and are broadcast.

Cases: null and empty texts match nothing; repeated rows with one id give one row; a null id is kept;
without notices or documents the result is empty; other columns are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdflow.llm.common import staged

SHINGLE = 5
MISS = 1e-4

#: Licence notices (fixed values): name and wording.
NOTICES = [
    ("all-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[^a-z0-9]+", -1), "")


def shingles(text: Column, k: int) -> Column:
    """The k-word shingles of a text, in order, as 64-bit hashes."""
    def of(w: Column) -> Column:
        some = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w), F.lit(k)) - k),
                           lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(F.size(w) < k, F.array().cast("array<long>")).otherwise(some)

    # the words are bound once: wherever the planner moves this expression, they are not split again for each shingle
    return F.get(F.transform(F.array(words(text)), of), F.lit(0))


def size_class(n: int) -> int:
    """The smallest power of two that is n or more."""
    return 1 << max(0, (n - 1).bit_length())


def stride(size: int) -> int:
    return max(1, size // 4)


def bands(size: int, least: float) -> int:
    """Bands of one value that miss a notice of the class with a chance of at most MISS."""
    n = size // 2 + 1 if size > 1 else 1
    window = size + stride(size) - 1
    held = math.ceil(least * n)
    similar = held / (n + window - held)
    return 1 if similar >= 1 else math.ceil(math.log(MISS) / math.log(1 - similar))


def signature(sh: str, n: int) -> str:
    """SQL: the MinHash values of an array of shingles, one a band."""
    return f"transform(array({sh}), v -> transform(sequence(0, {n - 1}), b -> array_min(transform(v, x -> xxhash64(x, b)))))[0]"


def literal(values: set[int]) -> str:
    """SQL: an array of fixed numbers."""
    return f"CAST(split('{','.join(map(str, sorted(values)))}', ',') AS ARRAY<BIGINT>)"


def scan(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, least: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, license, notice, containment, first_word, n_windows) for each notice a document holds.

    `notice` is its place in the list, `first_word` the first word of the first window that holds
    the largest share, `n_windows` the number of windows that hold enough of it.
    """
    spark = docs.sparkSession
    listed = json.dumps([{"notice": i, "license": a, "wording": b} for i, (a, b) in enumerate(notices)])
    # rows of the engine's own: rows from the driver's Python would keep Python workers beside each executor
    given = spark.range(1).select(F.inline(F.from_json(F.lit(listed), "array<struct<notice int, license string, wording string>>")))
    given = given.withColumn("k", F.least(F.lit(SHINGLE), F.size(words(F.col("wording"))))).filter("k > 0")
    own = F.coalesce(*[F.when(F.col("k") == k, F.array_distinct(shingles(F.col("wording"), k))) for k in range(1, SHINGLE + 1)])
    given = given.withColumns({"own": own, "size": F.size(own)})
    # signatures, and the shingle behind each of their values
    kind = lambda size: (F.col("size") > size // 2) & (F.col("size") <= size)
    sizes = [1 << e for e in range(20)]
    signed = F.coalesce(*[F.when(kind(n), F.expr(signature("own", bands(n, least)))) for n in sizes])
    given = given.withColumn("signature", signed).withColumn("behind", F.expr(
        "flatten(transform(signature, (v, b) -> filter(own, x -> xxhash64(x, b) = v)))"))
    given = staged(given.select("notice", "license", "k", "size", "own", "signature", "behind"), "license-notices")
    rows = given.collect()   # the notices, a parameter
    anchors = {k: {x for r in rows if r.k == k for x in r.behind} for k in {r.k for r in rows}}
    near = F.lit(False)
    for k, xs in anchors.items():
        near = near | F.arrays_overlap(f"sh{k}", F.expr(literal(xs)))
    found = docs.select(F.col(id_col).alias("id"), *[shingles(F.col(text_col), k).alias(f"sh{k}") for k in anchors])
    found = staged(found.filter(near), "license-documents")
    out = found.selectExpr("id", "'' license", "0 notice", "0 start", "0D containment").limit(0)
    for k, size in sorted({(r.k, size_class(r.size)) for r in rows}):
        mine = [r for r in rows if (r.k, size_class(r.size)) == (k, size)]
        seen = literal({x for r in mine for x in r.behind})
        step = stride(size)
        windows = (found.filter(f"arrays_overlap(sh{k}, {seen})")
                   .select("id", F.col(f"sh{k}").alias("sh"), F.expr(f"explode(sequence(0, size(sh{k}) - 1, {step})) AS start"))
                   .select("id", "start", F.expr(f"slice(sh, start + 1, {size + step - 1}) AS window"))
                   .filter(f"arrays_overlap(window, {seen})"))
        values = windows.select("*", F.expr(f"posexplode({signature('window', bands(size, least))}) AS (band, value)"))
        lookup = given.filter((F.col("k") == k) & kind(size)).selectExpr("notice", "license", "own", "posexplode(signature) AS (band, value)")
        met = values.join(F.broadcast(lookup), ["band", "value"])      # the notices' bands, a parameter
        share = met.withColumn("containment", F.expr("size(array_intersect(own, window)) / size(own)")).filter(F.col("containment") >= least)
        out = out.unionAll(share.select("id", "license", "notice", "start", "containment"))
    best = staged(out, "license-windows").groupBy("id", "license", "notice").agg(
        F.max("containment").alias("containment"), F.max_by("start", F.struct("containment", -F.col("start"))).alias("first_word"),
        F.count_distinct("start").alias("n_windows"))
    return best.select(F.col("id").alias(id_col), "license", "notice", "containment", F.col("first_word").cast("long").alias("first_word"), "n_windows")


def scan_sql(notices: list[tuple[str, str]] = NOTICES, least: float = 0.8) -> str:
    """DuckDB SQL for the same result over `documents`, from windows of words without signatures."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    listed = ",\n".join(f"({i}, {quote(a)}, {quote(b)})" for i, (a, b) in enumerate(notices))
    low = f"translate(%s, '{UPPER}', '{LOWER}')"
    return f"""
WITH notices(notice, license, wording) AS (VALUES {listed}),
nw AS (SELECT notice, license, regexp_extract_all({low % 'wording'}, '[a-z0-9]+') AS w FROM notices),
nk AS (SELECT *, least({SHINGLE}, len(w)) AS k FROM nw WHERE len(w) > 0),
own AS (SELECT DISTINCT notice, license, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
        FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM nk)),
sized AS (SELECT *, count(*) OVER (PARTITION BY notice) AS n FROM own),
classed AS (SELECT *, CAST(pow(2, ceil(log2(n))) AS BIGINT) AS size, greatest(1, CAST(pow(2, ceil(log2(n))) AS BIGINT) // 4) AS step FROM sized),
dw AS (SELECT doc_id, regexp_extract_all({low % "coalesce(text, '')"}, '[a-z0-9]+') AS w FROM documents),
ds AS (SELECT doc_id, k, len(w) - k + 1 AS total, i - 1 AS pos, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM nk))),
hit AS (SELECT d.doc_id, c.license, c.notice, c.n, c.size, c.step, d.pos, d.s FROM ds d JOIN classed c ON d.s = c.s AND d.k = c.k),
win AS (SELECT *, unnest(range(greatest(0, ((pos - size - step + 2 + step - 1) // step)) * step, pos + 1, step)) AS start FROM hit),
held AS (SELECT doc_id, license, notice, start, count(DISTINCT s) / n AS containment FROM win
         WHERE pos < start + size + step - 1 GROUP BY doc_id, license, notice, start, n HAVING count(DISTINCT s) / n >= {least})
SELECT doc_id, license, notice, max(containment) AS containment,
       CAST(arg_min(start, (-containment, start)) AS BIGINT) AS first_word, count(DISTINCT start) AS n_windows
FROM held GROUP BY doc_id, license, notice
"""
