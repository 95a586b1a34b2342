"""Heuristic quality rules: a threshold table compiled into one projection. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_or_empty

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"

#: Function words of the languages at hand. They count in lower case or with a leading capital, not when shouted.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by this are from at "
    "der die und das in den von zu ist nicht mit auf ein eine sich im dem "
    "le la les de des et en un une que dans est pour pas par sur "
    "el los las del y se con una es al no lo"
).split()


class Rule(NamedTuple):
    """A document passes where low * denominator <= numerator <= high * denominator (None: no bound)."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.5, 12.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.6),
    Rule("line_length", "n_words", "n_lines", 1.5, None),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside three-word windows that a text holds twice or more: sort the windows, keep those with an equal neighbour."""
    windows = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("w"), i.alias("i"))
    )
    windows = F.when(n >= 3, windows).otherwise(F.array().cast("array<struct<w:string,i:int>>"))

    def covered(s: Column) -> Column:
        twice = F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["w"] == x["w"]) | (F.get(s, k + 1)["w"] == x["w"]), x["i"]))
        starts = F.sort_array(F.filter(twice, lambda i: i.isNotNull()))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        sweep = F.aggregate(
            starts, zero, lambda a, i: F.struct((a["n"] + 3 - F.greatest(F.lit(0), a["end"] - i)).alias("n"), (i + 3).alias("end"))
        )
        return sweep["n"]

    return _let(F.sort_array(windows), covered)


def rule_failures(rules: tuple[Rule, ...]) -> Column:
    """The names of the rules that a row of metrics breaks."""
    broken = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (F.col(r.numerator) < r.low * F.col(r.denominator))
        if r.high is not None:
            bad = bad | (F.col(r.numerator) > r.high * F.col(r.denominator))
        broken.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    min_words: int = 50,
    most_repeated: int = 50,
) -> DataFrame:
    """One row per document: `id_col`, the counts, base_failed, kept and `failed` (names of the rules broken).

    No shuffle: each row is judged alone. base_failed marks fewer than `min_words` words or more than `most_repeated`
    per cent of words in repeated three-word windows; it rules out a document whatever the table says. Null texts have
    no words and fail; very long texts sort their own windows. Rows that repeat an id stay apart.
    """
    text = text_or_empty(text_col)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    stop = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})

    def counts(ws: Column) -> Column:
        n = F.size(ws)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            _repeat_words(ws, n).cast("long").alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
        )

    line_counts = _let(
        lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    )
    m = docs.select(
        F.col(id_col).alias("id"),
        _let(words, counts).alias("c"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        line_counts.alias("l"),
    ).select("id", "c.n_words", "c.word_chars", "n_symbols", "l.n_dup_lines", "c.n_repeat_words", "c.n_stop_words", "l.n_lines")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    m = m.withColumn("base_failed", base).withColumn("failed", rule_failures(rules))
    return m.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"), "n_stop_words", "n_lines", "failed",
    )


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


RULES_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT rid, doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
d AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS n FROM g),
r AS (SELECT rid, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM d WHERE n > 1) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda y: length(y))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(x, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda y: y IN ({_quoted(sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)}))}))) AS n_stop, len(ls) AS n_lines
      FROM w LEFT JOIN r USING (rid)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             word_chars < 2.5::DOUBLE * n_words OR word_chars > 12.0::DOUBLE * n_words OR n_symbols > 0.3::DOUBLE * n_words
             OR n_stop < 0.02::DOUBLE * n_words OR n_dup_lines > 0.6::DOUBLE * n_lines OR n_words < 1.5::DOUBLE * n_lines AS broken FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT broken AS kept FROM v
"""
