"""License scans by diagonal voting.

Every text is read once. Its rolling word pairs are hashed in place, and places whose hash no license template
has fall away there; the rest are joined to the places where templates hold the same pair and confirmed
on the words themselves, three of them where the template goes on. A hit votes for the diagonal
``place in document - place in template``. Votes are bits, one per template place, so that counting is one
bitwise or that combines before the shuffle and that repeated rows cannot distort.

A phrase stands wherever all its bits are set on one diagonal. Longer templates may be edited: diagonals
at most DRIFT behind a first one are merged, and the span they cover is verified: the words that hits
hold, in their order, against the words of the template and of the span, whichever are more. So
inserted words count against a span, and hits that drift apart never make one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexistat.llm.words import ALPHANUMERIC, lower_ascii, whole_text
from lexistat.session import stage

# Phrases whose every occurrence counts, with their labels.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Passages of well-known licenses and notices; a sufficient share of their words gives the label.
PASSAGES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc", "this work is licensed under a creative commons attribution"),
    ("cc", "licensed under cc by"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("reserved", "all rights reserved"),
)
# Whole texts of short licenses.
TEXTS = (
    ("mit", """
    permission is hereby granted free of charge to any person obtaining a copy of this software and associated
    documentation files the software to deal in the software without restriction including without limitation the
    rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
    persons to whom the software is furnished to do so subject to the following conditions the above copyright notice
    and this permission notice shall be included in all copies or substantial portions of the software the software is
    provided as is without warranty of any kind express or implied including but not limited to the warranties of
    merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright
    holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise
    arising from out of or in connection with the software or the use or other dealings in the software"""),
    ("bsd", """
    redistribution and use in source and binary forms with or without modification are permitted provided that the
    following conditions are met 1 redistributions of source code must retain the above copyright notice this list of
    conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice
    this list of conditions and the following disclaimer in the documentation and or other materials provided with the
    distribution this software is provided by the copyright holders and contributors as is and any express or implied
    warranties including but not limited to the implied warranties of merchantability and fitness for a particular
    purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect
    incidental special exemplary or consequential damages including but not limited to procurement of substitute goods
    or services loss of use data or profits or business interruption however caused and on any theory of liability
    whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of
    this software even if advised of the possibility of such damage"""),
    ("isc", """
    permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
    provided that the above copyright notice and this permission notice appear in all copies the software is provided
    as is and the author disclaims all warranties with regard to this software including all implied warranties of
    merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential
    damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract
    negligence or other tortious action arising out of or in connection with the use or performance of this software"""),
)
BITS = 61  # template places in one vote; two bits are left for the words behind the last one
COVERED = 0.6  # share of the words that confirms a span
DRIFT = 4  # words that may be inserted in all


def templates() -> list[tuple[int, str, bool, int, int, int, str, str, str | None]]:
    """``(template, label, phrase, words, grams, place, first, second, third)`` for every gram."""
    rows = []
    kinds = [(*t, True) for t in PHRASES] + [(*t, False) for t in (*PASSAGES, *TEXTS)]
    for number, (label, text, phrase) in enumerate(kinds):
        words = text.split()
        k = min(3, len(words))
        grams = len(words) - k + 1
        for place in range(grams):
            gram = [*words[place : place + k], None][:3]
            rows.append((number, label, phrase, len(words), grams, place, *gram))
    return rows


PARTS = -(-max(row[4] for row in templates()) // BITS)
_HITS = [f"hits{part}" for part in range(PARTS)]


def template_table(spark: SparkSession) -> DataFrame:
    names = ("template", "label", "phrase", "words", "grams", "place", "first", "second", "third")
    rows = [
        F.struct(*[
            (F.lit(v) if v is not None else F.lit(None).cast("string")).alias(n)
            for n, v in zip(names, row, strict=True)
        ])
        for row in templates()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def hits(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, n_words, hits)``, staged: the words of every text, and where a template's pair stands.

    ``hits`` is an array of ``struct<at, a, b, c>``: the place and the words there.
    """
    words = F.regexp_extract_all(lower_ascii(whole_text()), F.lit(ALPHANUMERIC), F.lit(0))
    pairs = F.lit(sorted({f"{row[6]} {row[7]}" for row in templates()}))
    known = F.transform(pairs, lambda pair: F.xxhash64(F.split_part(pair, F.lit(" "), F.lit(1)),
                                                       F.split_part(pair, F.lit(" "), F.lit(2))))
    listed = docs.sparkSession.range(1).select(known.alias("known")).first()["known"]
    cut = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words.alias("words"))
    rolling = F.zip_with(
        "words", F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b),
    )
    places = F.array_compact(F.transform(rolling, lambda h, i: F.when(h.isin(listed), i)))
    found = F.transform(
        places,
        lambda i: F.struct(
            i.alias("at"), F.get("words", i).alias("a"), F.get("words", i + 1).alias("b"), F.get("words", i + 2).alias("c")
        ),
    )
    return stage(
        cut.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), found.alias("hits")), "hits"
    )


def votes(found: DataFrame) -> DataFrame:
    """Votes of ``hits``: for every document, template and diagonal the bits of its places, and where they stand."""
    known = template_table(found.sparkSession)
    hit = found.select("doc_id", "text_hash", F.inline("hits"))
    same = (
        (hit["a"] == known["first"]) & (hit["b"] == known["second"])
        & (known["third"].isNull() | (hit["c"] == known["third"]))
    )
    place = F.col("place")
    bits = [
        F.coalesce(
            F.bit_or(F.when(F.floor(place / BITS) == part, F.expr(f"shiftleft(1L, place % {BITS})"))), F.lit(0).cast("long")
        ).alias(name)
        for part, name in enumerate(_HITS)
    ]
    # The templates are the constants above, so their table has a fixed size.
    return (
        hit.join(F.broadcast(known), same)
        .groupBy(
            "doc_id", "text_hash", "template", "label", "phrase", "words", "grams",
            (F.col("at") - place).alias("diagonal"),
        )
        .agg(*bits, F.min("at").alias("begin"), (F.max("at") + 3).alias("end"))
    )


def _count(columns: list[Column]) -> Column:
    return reduce(Column.__add__, [F.bit_count(c) for c in columns])


def _held_words(bits: list[Column]) -> Column:
    """How many words of the template the hits hold: each its own place and the two behind it."""
    three = [b.bitwiseOR(F.shiftleft(b, 1)).bitwiseOR(F.shiftleft(b, 2)) for b in bits]
    low = F.lit((1 << BITS) - 1).cast("long")
    own = [three[0].bitwiseAND(low)]
    for before, here in zip(three, three[1:], strict=False):
        own.append(here.bitwiseAND(low).bitwiseOR(F.shiftrightunsigned(before, BITS)))
    return _count(own) + F.bit_count(F.shiftrightunsigned(three[-1], BITS))


def spans(found: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, template, label, phrase, start, coverage)`` of ``hits``: verified places.

    A phrase gives one span per place. Another template gives one where the words its hits hold are
    enough of the template and of the span from the first to the last of them; ``start`` is the first.
    """
    every = stage(votes(found), "votes")
    names = ("doc_id", "text_hash", "template", "label", "phrase")
    whole = _count([F.col(c) for c in _HITS]) == F.col("grams")
    exact = every.filter(F.col("phrase") & whole).select(
        *names, F.col("diagonal").alias("start"), F.lit(1.0).alias("coverage")
    )
    along = Window.partitionBy(*names[:3]).orderBy("diagonal")
    near = along.rangeBetween(0, DRIFT)
    merged = every.filter(~F.col("phrase")).select(
        *names, "words", "diagonal", *[F.bit_or(c).over(near).alias(c) for c in _HITS],
        F.min("begin").over(near).alias("begin"), F.max("end").over(near).alias("end"),
    )
    length = F.greatest(F.col("words"), F.col("end") - F.col("begin"))
    covering = merged.withColumn("coverage", _held_words([F.col(c) for c in _HITS]) / length)
    better = F.max("coverage").over(along.rangeBetween(-DRIFT, -1))
    first = covering.filter(F.col("coverage") >= COVERED).withColumn("better", better)
    return exact.unionByName(
        first.filter(F.col("better").isNull() | (F.col("better") < F.col("coverage"))).select(
            *names, F.col("begin").alias("start"), "coverage"
        )
    )


def _labels(names: str) -> Column:
    return F.array_join(F.array_sort(F.col(names)), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the fixed phrases, overlapping ones included; ``first_word`` and
    ``last_word`` are the smallest and largest (null without one). ``base_labels`` holds the
    phrases' labels, ``labels`` those of the other templates too, each sorted and joined by commas, ''
    without any. ``score`` is the best coverage, 0 without a span. Null and empty texts have no words.
    Repeated rows give the same result each; equal ids with other texts are documents of their own.
    """
    read = hits(docs)
    base = F.col("phrase")
    found = spans(read.filter(F.size("hits") > 0).dropDuplicates(["doc_id", "text_hash"])).groupBy(
        "doc_id", "text_hash"
    ).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("_base"),
        F.collect_set("label").alias("_all"),
        F.max("coverage").alias("score"),
    ).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_base", "first_word",
        "last_word", _labels("_base").alias("base_labels"), _labels("_all").alias("labels"), "score",
    )
    counted = read.select("doc_id", "text_hash", "n_words")
    same = counted["doc_id"].eqNullSafe(found["_id"]) & (counted["text_hash"] == found["_hash"])
    return counted.join(found, same, "left").select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _value(v: object) -> str:
    return "NULL" if v is None else str(v) if not isinstance(v, str) else f"'{v}'"


def _held_sql(names: list[str]) -> str:
    three = [f"({n} | ({n} << 1) | ({n} << 2))" for n in names]
    low = (1 << BITS) - 1
    own = [f"bit_count({three[0]} & {low})"]
    own += [f"bit_count(({here} & {low}) | ({before} >> {BITS}))" for before, here in zip(three, three[1:], strict=False)]
    return " + ".join([*own, f"bit_count({three[-1]} >> {BITS})"])


SQL = f"""
WITH known(template, label, phrase, words, grams, place, first, second, third) AS (
    VALUES {", ".join("(" + ", ".join(map(_value, row)) + ")" for row in templates())}
), cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), grams AS (
    SELECT doc_id, pos, words[pos + 1] AS a, words[pos + 2] AS b, words[pos + 3] AS c
    FROM (SELECT doc_id, words, unnest(range(len(words) - 1)) AS pos FROM cut)
), votes AS (
    SELECT doc_id, template, label, phrase, words, grams, pos - place AS diagonal, min(pos) AS b, max(pos) + 3 AS e,
           {", ".join(f"coalesce(bit_or(1::BIGINT << (place % {BITS})) FILTER (place // {BITS} = {i}), 0) AS {n}" for i, n in enumerate(_HITS))}
    FROM grams JOIN known ON a = first AND b = second AND (third IS NULL OR third = c)
    GROUP BY ALL
), merged AS (
    SELECT doc_id, label, words, {", ".join(f"bit_or({n}) OVER near AS {n}" for n in _HITS)},
           max(e) OVER near - min(b) OVER near AS length
    FROM votes WHERE NOT phrase
    WINDOW near AS (PARTITION BY doc_id, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {DRIFT} FOLLOWING)
), spans AS (
    SELECT doc_id, label, phrase, diagonal AS start, 1.0::DOUBLE AS coverage
    FROM votes WHERE phrase AND {" + ".join(f"bit_count({n})" for n in _HITS)} = grams
    UNION ALL
    SELECT doc_id, label, false, NULL, ({_held_sql(_HITS)}) / greatest(words, length) AS coverage
    FROM merged WHERE coverage >= {COVERED}
), found AS (
    SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word,
           max(start) FILTER (phrase) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
    FROM spans GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM cut LEFT JOIN found USING (doc_id)
"""
