"""Deletion of repeated line runs by a suffix array over line ids.

A text is the sequence of its lines that hold words. Lines found only once cannot be in a repeated run;
the others get ids, and the suffixes that start at them are sorted by prefix doubling: the rank of the
2**(k+1) lines from a place on is the place of (rank of its first 2**k lines, rank of the next 2**k) in the order of all such pairs.
Only distinct pairs are sorted, so a line that is everywhere is one row, and pairs found once drop
out. A run matters from ``least_words`` words on, which no more than that many lines have, so
doubling ends there.

Suffixes that agree in their first n lines lie together in this order: an LCP interval of depth n. It is
named by two overlapping ranks, those of the first and of the last 2**k of the n lines. For every place the interval
of the fewest lines that hold ``least_words`` words, counted on from it and back from it, tells whether
they stand anywhere before; together these windows cover exactly the maximal repeated runs of
at least that many words. The first copy stays, all lines of later ones go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexistat.llm.shipping import ship
from lexistat.llm.words import SPACED, row_of, usual_parts
from lexistat.operators.ordering import global_index
from lexistat.session import stage

LEAST_WORDS = 50
KEY = ("doc_id", "text_hash")


def lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, place, words, a, b)``: lines with words, numbered from 0, as hashes.

    Lines are told apart without the white space around them, by 128 bits.
    """
    split = F.split(F.col("text"), "\n")
    counted = F.filter(
        F.transform(split, lambda x: F.struct(F.trim(x, F.lit(" \t\r\x0b\x0c")).alias("line"))),
        lambda x: x["line"] != "",
    )
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        F.posexplode(counted).alias("place", "held"),
    )
    line = F.col("held.line")
    return out.select(
        *KEY, "place", F.regexp_count(line, F.lit(SPACED)).alias("words"), F.xxhash64(line).alias("a"),
        F.xxhash64(line, F.lit(1)).alias("b"),
    )


def ranked(pairs: DataFrame, name: str) -> DataFrame:
    """``(a, b, name)``: the places of the pairs found more than once in the order of all of them."""
    repeated = stage(
        pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("a", "b"), "pairs"
    )
    return global_index(repeated, [F.col("a").asc(), F.col("b").asc()], name, 1, usual_parts(pairs.sparkSession))


def suffixes(docs: DataFrame, least_words: int = LEAST_WORDS) -> tuple[DataFrame, int]:
    """The suffixes at repeated lines with their ranks, and the number of ranks.

    ``(doc_id, text_hash, run, place, words, on, back, r0, r1, ...)``: ``run`` numbers the stretches of
    repeated lines of a text; ``on`` and ``back`` are the least numbers of lines that hold
    ``least_words`` words from the place on and back (null where the stretch is too short); ``r<k>`` is the rank by 2**k lines,
    null where they are found once.
    """
    every = stage(lines(docs), "lines")
    known = ranked(every, "r0")
    active = every.join(known, ["a", "b"]).select(*KEY, "place", "words", "r0").dropDuplicates([*KEY, "place"])
    by_place = Window.partitionBy(*KEY).orderBy("place")
    within = Window.partitionBy(*KEY, "run").orderBy("place")
    islands = active.withColumn("run", F.col("place") - F.row_number().over(by_place))
    so_far = islands.withColumn(
        "end", F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("begin", F.col("end") - F.col("words"))
    ahead = Window.partitionBy(*KEY, "run").orderBy("begin").rangeBetween(0, least_words - 1)
    behind = Window.partitionBy(*KEY, "run").orderBy("end").rangeBetween(1 - least_words, 0)

    def enough(frame: Window) -> Column:
        return F.when(F.sum("words").over(frame) >= least_words, F.count(F.lit(1)).over(frame).cast("int"))

    rows = stage(
        so_far.select(
            *KEY, "run", "place", "words", enough(ahead).alias("on"), enough(behind).alias("back"), "r0"
        ),
        "suffixes",
    )
    longest = rows.agg(F.max(F.greatest("on", "back"))).first()[0] or 1
    level = 0
    while 2 << level <= longest:
        rank, step = f"r{level}", 1 << level
        pairs = stage(
            rows.withColumn("a", F.col(rank)).withColumn("b", F.lead(rank, step).over(within)), "doubled"
        )
        both = pairs.filter("a IS NOT NULL AND b IS NOT NULL")
        level += 1
        rows = stage(pairs.join(ranked(both, f"r{level}"), ["a", "b"], "left").drop("a", "b"), "suffixes")
    return rows, level + 1


def later_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(doc_id, text_hash, first, size)``: windows of lines whose like stands somewhere before.

    Before means in a smaller (doc_id, text_hash), or further up in the same text.
    """
    rows, levels = suffixes(docs, least_words)
    ranks = F.array(*[F.col(f"r{k}") for k in range(levels)])
    runs = rows.groupBy(*KEY, "run").agg(
        F.array_sort(F.collect_list(F.struct("place", "on", "back", ranks.alias("ranks")))).alias("held")
    )

    def window(size: Column, begin: Column) -> Column:
        """A window's begin in its stretch, its size and its name."""
        level = F.floor(F.log2(size)).cast("int")
        tail = begin + size - F.pow(F.lit(2), level).cast("int")
        held = F.col("held")
        return F.struct(
            begin.alias("begin"), size.alias("size"),
            F.get(F.get(held, begin)["ranks"], level).alias("a"), F.get(F.get(held, tail)["ranks"], level).alias("b"),
        )

    both = F.concat(
        F.transform("held", lambda x, i: window(x["on"], i)),
        F.transform("held", lambda x, i: window(x["back"], i - x["back"] + 1)),
    )
    named = stage(
        runs.select(*KEY, F.get("held", F.lit(0))["place"].alias("start"), F.explode(both).alias("w"))
        .select(*KEY, (F.col("start") + F.col("w.begin")).alias("first"), F.col("w.size").alias("size"), "w.a", "w.b")
        .filter("size IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL")
        .distinct(),
        "windows",
    )
    place = F.struct(*KEY, "first")
    # Written before it is joined: a join of two plain tables can split a window found everywhere.
    intervals = stage(
        named.groupBy("size", "a", "b").agg(
            F.min(place).alias("earliest"), F.count(F.lit(1)).alias("_n")
        ).filter("_n > 1").drop("_n"),
        "intervals",
    )
    return named.join(intervals, ["size", "a", "b"]).filter(place != F.col("earliest")).select(*KEY, "first", "size")


def cleaned(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(row, n_lines, n_removed, text)`` for every row of ``docs``, ``row`` being the row as it was.

    ``n_lines`` counts lines with words (0 for null and empty texts), ``n_removed`` those deleted. Lines without
    words stay, except behind a deleted line. A text without deletions is returned as it is, null
    included. Rows that agree in id and text are one text and are treated alike; an empty
    table gives no rows.
    """
    ship(docs.sparkSession)
    gone = later_copies(docs, least_words).groupBy(*KEY).agg(
        F.collect_list(F.struct("first", "size")).alias("gone")
    ).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "gone")
    rows = docs.select(
        row_of(docs), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    joined = rows.join(
        gone, rows["doc_id"].eqNullSafe(gone["_id"]) & (rows["text_hash"] == gone["_hash"]), "left"
    ).select("_row", "text", "gone")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, texts = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                split = (text or "").split("\n")
                worded = [bool(line.strip(" \t\r\x0b\x0c")) for line in split]
                total = sum(worded)
                drop = bytearray(total)
                for window in gone or ():
                    drop[window["first"] : window["first"] + window["size"]] = b"\x01" * window["size"]
                totals.append(total)
                removed.append(sum(drop))
                if gone:
                    kept, at, dropping = [], 0, False
                    for line, has_words in zip(split, worded, strict=True):
                        if has_words:
                            dropping = bool(drop[at])
                            at += 1
                        if not dropping:
                            kept.append(line)
                    text = "\n".join(kept)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(texts, pa.string())],
                ["row", "n_lines", "n_removed", "text"],
            )

    row_type = rows.schema["_row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {row_type}, n_lines long, n_removed long, text string")


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` with their cleaned texts; same columns.

    ``n_chars``, where there is one, follows the text. A document of which nothing is left goes;
    documents that held no words before stay.
    """
    done = cleaned(docs, least_words).filter("n_lines = 0 OR n_removed < n_lines")
    columns = [F.col(f"row.`{name}`") for name in docs.columns]
    place = {name: i for i, name in enumerate(docs.columns)}
    columns[place["text"]] = F.col("text")
    if "n_chars" in place:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
        columns[place["n_chars"]] = length.alias("n_chars")
    return done.select(columns)


# What op10's query gives, from the texts of all windows.
SQL = rf"""
WITH raw AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), trimmed AS (
    SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM raw
), worded AS (
    SELECT doc_id, pos, bare, len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) AS words,
           row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS place
    FROM trimmed WHERE bare <> ''
), summed AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY place) AS fin FROM worded
), whole AS (
    SELECT doc_id, list(bare ORDER BY place) AS held FROM worded GROUP BY doc_id
), sizes AS (
    SELECT doc_id, place AS first, count(*) OVER ahead AS size, sum(words) OVER ahead AS held_words FROM summed
    WINDOW ahead AS (PARTITION BY doc_id ORDER BY fin - words RANGE BETWEEN CURRENT ROW AND {LEAST_WORDS - 1} FOLLOWING)
    UNION
    SELECT doc_id, place + 1 - count(*) OVER behind, count(*) OVER behind, sum(words) OVER behind FROM summed
    WINDOW behind AS (PARTITION BY doc_id ORDER BY fin RANGE BETWEEN {LEAST_WORDS - 1} PRECEDING AND CURRENT ROW)
), windows AS (
    SELECT doc_id, first, size, held[first + 1 : first + size] AS content
    FROM sizes JOIN whole USING (doc_id) WHERE held_words >= {LEAST_WORDS}
), later AS (
    SELECT doc_id, first, size FROM (
        SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, first) AS turn FROM windows)
    WHERE turn > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(first, first + size)) AS place FROM later
), marked AS (
    SELECT t.doc_id, t.line, t.pos, w.place IS NOT NULL AS has_words,
           CASE WHEN w.place IS NOT NULL THEN g.place IS NOT NULL END AS drop
    FROM trimmed t LEFT JOIN worded w USING (doc_id, pos) LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place
), carried AS (
    SELECT *, coalesce(last_value(drop IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos), false) AS dropping FROM marked
), kept AS (
    SELECT doc_id, count(*) FILTER (has_words) AS n_lines, count(*) FILTER (drop) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropping), '') AS text
    FROM carried GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN n_removed > 0 THEN k.text ELSE d.text END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
