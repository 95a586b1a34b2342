"""License scans by diagonal voting over rolling word k-grams. DataFrame functions only."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Between words: ASCII but digits and small letters (of a text in lower case).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a gram.
K = 3
#: Words of a template at most: its grams are bits of one long, and so are its words.
MOST_WORDS = 64


class Template(NamedTuple):
    """A notice and the part of it that has to stand word for word (`all`: the whole of it, on one diagonal)."""

    label: str
    text: str
    must: str = "all"
    base: bool = False


# The phrases that every scan reports, and notices as their licenses give them.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc0", "cc0 1 0 universal"),
    Template("epl-2", "eclipse public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "this software"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software",
        "free of charge to any person",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at",
        "the apache license version 2",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "source and binary forms",
    ),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered"),
    *(
        Template(
            f"gpl-{n}",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
            f"published by the free software foundation either version {n} of the license or at your option any later version",
            f"either version {n}",
        )
        for n in (2, 3)
    ),
)


def _grams_of(template: Template) -> tuple[list[str], int]:
    """Words, and the bits of the words that must stand as they are."""
    words = template.text.split()
    if not K <= len(words) <= MOST_WORDS:
        raise ValueError(f"a template has {K} to {MOST_WORDS} words: {template.text}")
    must = words if template.must == "all" else template.must.split()
    at = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
    return words, sum(1 << i for i in range(at, at + len(must)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _lower(text: Column) -> Column:
    """A-Z in lower case. Other letters may change too, which no template sees; two that would turn into ASCII letters are put aside."""
    return F.lower(F.replace(F.replace(text, F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é")))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    slack: int = 4,
    least: float = 0.75,
) -> DataFrame:
    """One row per document: `id_col`, n_words, n_base, first_word, last_word, base_labels, labels, score.

    All rolling grams of `K` words of all texts are hashed and joined with the templates' grams, a table of fixed size;
    a hit counts where the words are equal as well. A hit votes for the diagonal of its template, the place in the text
    less the place in the template. Votes of a diagonal are summed up before the shuffle, as bits of the template's
    grams, so what is dealt out is one row for each document and diagonal with a hit. Diagonals of a document and
    template that are at most `slack` words apart are merged, as words that were put in or left out shift the rest of a
    notice. A merged span is verified: the words that its grams cover have to be `least` of the template and hold the
    part that must stand word for word, and its diagonals must not drift by more than half of the template. Templates
    that must stand as a whole are not merged: all their grams vote for one diagonal, and that is a place of the phrase.

    n_base counts the places of the base phrases, first_word and last_word are the first and last of their starts (words
    from 0; null without one). base_labels are theirs, labels those of all verified spans too, each distinct, sorted and
    joined by commas. score is the largest part of a template that any merged span covers, 1 for a whole one.

    No row leaves its task before its grams have voted, so a line that very many documents share costs each of them
    a row. Null and empty texts have no words; a very long text is one row that is exploded as it is read. Rows that
    repeat an id stay apart. An empty table gives an empty result. Extra columns do not matter.
    """
    spark = docs.sparkSession
    labels = sorted({t.label for t in templates})
    grams, facts = [], []
    for i, t in enumerate(templates):
        words, must = _grams_of(t)
        grams += [(i, p, _signed(1 << p), *words[p : p + K]) for p in range(len(words) - K + 1)]
        facts.append((i, len(words), _signed(must), t.must == "all", t.base, 1 << labels.index(t.label)))
    g = spark.createDataFrame(grams, "t int, p int, bit long, w0 string, w1 string, w2 string")
    g = g.select(F.xxhash64("w0", "w1", "w2").alias("h"), "*")
    f = spark.createDataFrame(facts, "t int, length int, must long, whole boolean, base boolean, label long")

    words = F.array_remove(F.split(_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), BETWEEN), "")
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), words.alias("words"))
    rows = rows.select("key", "id", "words", F.posexplode_outer("words").alias("pos", "a"))
    b, c = F.get("words", F.col("pos") + 1), F.get("words", F.col("pos") + 2)
    rows = rows.select("key", "id", F.size("words").alias("n"), "pos", "a", b.alias("b"), c.alias("c"), F.xxhash64("a", b, c).alias("own"))
    hits = rows.join(F.broadcast(g), F.col("own") == F.col("h"), "left")
    equal = (F.col("a") == F.col("w0")) & (F.col("b") == F.col("w1")) & (F.col("c") == F.col("w2"))
    hits = hits.select("key", "id", "n", "pos", *[F.when(equal, F.col(x)).alias(x) for x in ("t", "p", "bit")])
    # a document's first word stands for the document
    hits = hits.where(F.col("t").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0))
    votes = hits.groupBy("key", "id", "t", (F.col("pos") - F.col("p")).alias("diagonal")).agg(F.max("n").alias("n"), F.bit_or("bit").alias("bits"))

    # diagonals in order, by document; a step of more than `slack` starts another span
    votes = votes.join(F.broadcast(f), "t", "left")
    order = Window.partitionBy("key").orderBy("t", "diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    far = F.lag("t").over(order).isNull() | (F.lag("t").over(order) != F.col("t")) | F.col("whole") | (step > slack)
    votes = votes.withColumn("far", far).withColumn("span", F.sum(F.when(F.col("far"), 1).otherwise(0)).over(order))
    facts_of = [F.first(x).alias(x) for x in ("length", "must", "whole", "base", "label")]
    drift = (F.max("diagonal") - F.min("diagonal")).alias("drift")
    spans = votes.groupBy("key", "id", "t", "span").agg(
        F.max("n").alias("n"), F.bit_or("bits").alias("bits"), F.min("diagonal").alias("start"), drift, *facts_of
    )
    bits = F.col("bits")
    covered = bits.bitwiseOR(F.shiftleft(bits, 1)).bitwiseOR(F.shiftleft(bits, 2))
    spans = spans.withColumn("covered", covered).withColumn("part", F.bit_count("covered") / F.col("length"))
    good = (F.col("covered").bitwiseAND(F.col("must")) == F.col("must")) & (F.col("part") >= least) & (2 * F.col("drift") <= F.col("length"))
    place = good & F.col("base")
    found = spans.groupBy("key", "id").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"),
        F.bit_or(F.when(place, F.col("label"))).alias("base_bits"),
        F.bit_or(F.when(good, F.col("label"))).alias("all_bits"),
        F.coalesce(F.max("part"), F.lit(0.0)).alias("score"),
    )

    def named(bits: str) -> Column:
        return F.concat_ws(",", *[F.when(F.col(bits).bitwiseAND(F.lit(1 << i)) != 0, F.lit(x)) for i, x in enumerate(labels)])

    return found.select(
        F.col("id").alias(id_col), F.greatest("n_words", F.lit(0)).alias("n_words"), "n_base", "first_word", "last_word",
        named("base_bits").alias("base_labels"), named("all_bits").alias("labels"), "score",
    )


def _licenses_sql(templates: tuple[Template, ...] = TEMPLATES, slack: int = 4, least: float = 0.75) -> str:
    """Base phrases as lists of words; the notices by their grams' diagonals."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = ", ".join(f"({i}, '{t.label}', string_split('{t.text}', ' '), string_split('{t.must}', ' '), {str(t.base).lower()})" for i, t in enumerate(templates))
    word = re.sub("^.", "[^", BETWEEN)
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}') AS ws
        FROM documents),
t(t, label, ts, must, base) AS (VALUES {rows}),
tg AS (SELECT t, p, ts[p] || ' ' || ts[p + 1] || ' ' || ts[p + 2] AS g FROM (SELECT t, ts, unnest(range(1, len(ts) - 1)) AS p FROM t)),
dg AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
hit AS (SELECT rid, t, i - p AS diagonal, p FROM dg JOIN tg USING (g)),
diag AS (SELECT rid, t, diagonal, list(p) AS ps FROM hit GROUP BY ALL),
step AS (SELECT *, CASE WHEN must = ['all'] OR diagonal - lag(diagonal) OVER w <= {slack} IS NOT TRUE THEN 1 ELSE 0 END AS far
         FROM diag JOIN t USING (t) WINDOW w AS (PARTITION BY rid, t ORDER BY diagonal)),
runs AS (SELECT *, sum(CASE WHEN must = ['all'] THEN 1 ELSE far END) OVER (PARTITION BY rid, t ORDER BY diagonal) AS run FROM step),
span AS (SELECT rid, t, run, min(diagonal) AS start, max(diagonal) - min(diagonal) AS drift,
                list_distinct(flatten(list(list_concat(ps, list_transform(ps, lambda p: p + 1), list_transform(ps, lambda p: p + 2))))) AS cov
         FROM runs GROUP BY ALL),
judged AS (SELECT s.*, label, base, len(cov) / len(ts) AS part,
                  len(cov) / len(ts) >= {least} AND 2 * drift <= len(ts)
                  AND list_has_all(cov, CASE WHEN must = ['all'] THEN range(1, len(ts) + 1)
                      ELSE (list_filter(list_transform(range(1, len(ts) + 1), lambda q: CASE WHEN ts[q:q + len(must) - 1] = must THEN range(q, q + len(must)) END),
                                        lambda x: x IS NOT NULL))[1] END) AS good
           FROM span s JOIN t USING (t)),
place AS (SELECT rid, label, start FROM (SELECT rid, ws, unnest(range(0, len(ws))) AS start FROM d) JOIN t ON base AND ws[start + 1] = ts[1]
          WHERE ws[start + 1:start + len(ts)] = ts),
b AS (SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
      FROM place GROUP BY rid),
m AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good) AS labels, max(part) AS score FROM judged GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN m USING (rid)
"""


LICENSES_SQL = _licenses_sql()
