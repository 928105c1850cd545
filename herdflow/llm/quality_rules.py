"""Quality rules: a table of thresholds compiled into one projection, in built-in functions only.

A rule bounds a ratio of two counts of a text, in per cent: `100 * part >= low * whole` and
`100 * part <= high * whole`, in whole numbers. The counts (`COUNTS`) are of

* length: words, and code points in words;
* symbols: the characters ``#*$%&|<>``, exclamation and question marks, words without any letter;
* stop words: words that are one of `STOP_WORDS`, as they are, with a capital or in capitals;
* lines: lines with a word, those equal to an earlier one, those that end in an ellipsis, that begin with a
  bullet, and words in five-word windows found twice or more in the text.

`judge` adds the counts, which rules fail, and the verdict, all in a projection over the table: there is no
shuffle, no Python and no group. Windows are compared by 64-bit hashes of their five words.
Only a text with a repeated window pays for the sort that finds the words in it.

Cases: a null text is an empty one, with all counts 0; a rule about a whole of 0 holds unless it asks for a
`least` number of things; repeated rows are judged each; a null id stays; a long text is one row like any
other, in time n log n; an empty table gives an empty result; other columns are not read by `judge` and all
kept by `keep_good`, which works beside columns of any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdflow.llm.common import ASCII_SPACE

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"

#: Frequent words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine für im in ist mit sich und von zu "
    "au dans de des du elle en est et la le les ou par pas pour que qui un une "
    "con de del el en es la las los no para por que se un una y").split()
STOP_WORDS = sorted(set(STOP_WORDS))


@dataclass(frozen=True)
class Rule:
    """A bound on `part` of `whole` in per cent, or, without a whole, on the number itself.

    It is judged only where the whole is `since` or more: a share of a few words says little.
    """

    name: str
    part: str
    whole: str | None = None
    low: int | None = None
    high: int | None = None
    since: int = 0

    def fails(self) -> str:
        """SQL: whether a text with these counts breaks the rule."""
        part, whole = (f"100 * {self.part}", self.whole) if self.whole else (self.part, "1")
        tests = [f"{part} < {self.low} * {whole}"] if self.low is not None else []
        tests += [f"{part} > {self.high} * {whole}"] if self.high is not None else []
        broken = "(" + " OR ".join(tests or ["false"]) + ")"
        return f"({broken} AND {whole} >= {self.since})" if self.since else broken


#: Rules that `base_failed` reports.
BASE_RULES = [Rule("few_words", "n_words", low=10), Rule("repeated_windows", "n_repeat_words", "n_words", high=20)]

#: Rules of the verdict besides those.
RULES = [
    Rule("word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=20),
    Rule("marks", "n_marks", "n_words", high=50),
    Rule("no_letters", "n_bare_words", "n_words", high=40),
    Rule("stop_words", "n_stop_words", "n_words", low=3, since=30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=50),
    Rule("bullets", "n_bullets", "n_lines", high=90),
]

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_bare_words",
          "n_stop_words", "n_lines", "n_cut_lines", "n_bullets"]
_WORD_CHAR, _CUT, _BULLET = rf"[^{ASCII_SPACE}]", rf"(\.\.\.|…)[{ASCII_SPACE}]*$", rf"^[{ASCII_SPACE}]*[-*•·‣▪][\x20\x09]"
#: A word without a letter, in the whole text.
_BARE = rf"(?<![^{ASCII_SPACE}])[^{ASCII_SPACE}\p{{L}}]+(?![^{ASCII_SPACE}])"
_PLACE_BITS = 28


def stop_forms(words: list[str] = STOP_WORDS) -> list[str]:
    """The words as they are, with a capital, and in capitals."""
    return sorted({f for x in words for f in (x, x.capitalize(), x.upper())})


def repeat_words(h: Column) -> Column:
    """Words that stand in a window found twice or more, from the hashes of all windows in order.

    One sort of plain numbers (part of the hash, then the place) finds places that may be repeats; whole hashes
    are compared for those only.
    """
    held = lambda test: F.coalesce(test, F.lit(False))
    let = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))  # noqa: E731  `value` computed once

    def covered(at: Column) -> Column:           # starts of such windows, in order
        new = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(new, F.lit(0), lambda n, x: n + x)

    def whole(s: Column) -> Column:
        twin = lambda e, i: held(F.get(s, i - 1)["h"] == e["h"]) | held(F.get(s, i + 1)["h"] == e["h"])
        at = F.transform(s, lambda e, i: F.when(twin(e, i), e["p"]))
        return let(F.sort_array(F.array_compact(at)), covered)

    def may(k: Column) -> Column:
        near = lambda x, other: held(x.bitwiseXOR(other) < 1 << _PLACE_BITS) & held(x.bitwiseXOR(other) >= 0)
        at = F.array_compact(F.transform(k, lambda x, i: F.when(
            near(x, F.get(k, i - 1)) | near(x, F.get(k, i + 1)), x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int"))))
        return let(F.sort_array(F.transform(at, lambda p: F.struct(F.get(h, p).alias("h"), p.alias("p")))), whole)

    keyed = F.transform(h, lambda x, i: F.shiftleft(x, _PLACE_BITS).bitwiseOR(i.cast("long")))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), let(F.sort_array(keyed), may)).otherwise(F.lit(0))


def counted(rows: DataFrame) -> DataFrame:
    """`row` and the `COUNTS` (longs) of each row of (row, t), where t is a text that is not null.

    Words, lines and hashes are columns of projections below, so each is made once and by generated code.
    """
    words = F.array_remove(F.split("t", f"[{ASCII_SPACE}]+", -1), "")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(_WORD_CHAR))
    windows = F.when(F.size("w") > WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("w") - WINDOW), lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(WINDOW)])))
    some = lambda pattern: F.regexp_count("t", F.lit(pattern))
    split = rows.select("row", "t", words.alias("w"), lines.alias("ls"))
    hashed = split.select("*", F.coalesce(windows, F.array().cast("array<long>")).alias("h"))
    found = {
        "n_words": F.size("w"), "word_chars": F.length(F.translate("t", " \t\n\x0b\x0c\r", "")),
        "n_symbols": some(SYMBOLS), "n_dup_lines": F.size("ls") - F.size(F.array_distinct("ls")),
        # never below 0, and not pushed by the planner into a filter, where it would be inlined and run again and again
        "n_repeat_words": F.greatest(repeat_words(F.col("h")), -F.spark_partition_id()), "n_marks": some("[!?]"), "n_bare_words": some(_BARE),
        "n_stop_words": F.expr("size(filter(w, x -> x IN ({})))".format(", ".join(f"'{x}'" for x in stop_forms()))), "n_lines": F.size("ls"),
        "n_cut_lines": F.size(F.filter("ls", lambda x: x.rlike(_CUT))),
        "n_bullets": F.size(F.filter("ls", lambda x: x.rlike(_BULLET))),
    }
    return hashed.select("row", *[found[c].cast("long").alias(c) for c in COUNTS])


def verdict(rules: list[Rule], base: list[Rule]) -> list[Column]:
    """base_failed, kept and the names of the rules that fail (a space between), from columns named as the counts."""
    names = F.array_compact(F.array(*[F.when(F.expr(r.fails()), F.lit(r.name)) for r in [*base, *rules]]))
    any_of = lambda rs: F.expr(" OR ".join(["false", *[r.fails() for r in rs]]))
    return [any_of(base).alias("base_failed"), (~any_of([*base, *rules])).alias("kept"),
            F.array_join(names, " ").alias("failed_rules")]


def judge(docs: DataFrame, rules: list[Rule] = RULES, base: list[Rule] = BASE_RULES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, the counts, base_failed, kept, failed_rules) for each row."""
    rows = docs.select(F.col(id_col).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return counted(rows).select(F.col("row").alias(id_col), *COUNTS, *verdict(rules, base))


def keep_good(docs: DataFrame, rules: list[Rule] = RULES, base: list[Rule] = BASE_RULES, text_col: str = "text") -> DataFrame:
    """The rows that break no rule, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return counted(rows).filter(verdict(rules, base)[1]).select("row.*")


def judge_sql(rules: list[Rule] = RULES, base: list[Rule] = BASE_RULES) -> str:
    """DuckDB SQL for the same result over `documents`, from a row a word and a row a line."""
    listed = ", ".join(f"'{s}'" for s in stop_forms())
    named = ", ".join(f"CASE WHEN {r.fails()} THEN '{r.name}' END" for r in [*base, *rules])
    any_of = lambda rs: " OR ".join(r.fails() for r in rs)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, generate_subscripts(ws, 1) AS p, unnest(ws) AS word
      FROM (SELECT r, regexp_extract_all(t, '[^{ASCII_SPACE}]+') AS ws FROM docs)),
win AS (SELECT r, p, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
               || ' ' || lead(word, 4) OVER o AS s FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, s) AS n FROM win WHERE s IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT q) AS n_repeat_words FROM (SELECT r, unnest(range(p, p + {WINDOW})) AS q FROM twice) GROUP BY r),
by_word AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
                   count(*) FILTER (NOT regexp_matches(word, '\\p{{L}}')) AS n_bare_words,
                   count(*) FILTER (word IN ({listed})) AS n_stop_words
            FROM w GROUP BY r),
l AS (SELECT r, line FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^{ASCII_SPACE}]')),
by_line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
                   count(*) FILTER (regexp_matches(line, '(\\.\\.\\.|…)[{ASCII_SPACE}]*$')) AS n_cut_lines,
                   count(*) FILTER (regexp_matches(line, '^[{ASCII_SPACE}]*[-*•·‣▪][\\x20\\x09]')) AS n_bullets FROM l GROUP BY r),
counted AS (SELECT doc_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in COUNTS)}
            FROM (SELECT r, doc_id, length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
                         length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_marks FROM docs)
            LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r) LEFT JOIN covered USING (r))
SELECT *, ({any_of(base)}) AS base_failed, NOT ({any_of([*base, *rules])}) AS kept,
       concat_ws(' ', {named}) AS failed_rules
FROM counted
"""
