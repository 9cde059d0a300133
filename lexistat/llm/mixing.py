"""Mixing sources to target weights by systematic sampling.

Every source has one rate, its target over its size. Its documents are laid out in a fixed order;
each takes as many copies as there are integers passed by the running sum of the rate, started
at one random offset per source. The running sum is the rate times a document's place, so all
that has to be known of the others is a place: a range sort of three narrow columns, and no
group of a source's rows. Documents lie in order of size, which keeps the words taken from a
source within about two of its largest documents of the target.

Rates are whole numbers of 2**-24, so sums are exact integers and no document can pass the cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexistat.llm.words import SPACED, row_of, usual_parts, whole_text
from lexistat.operators.ordering import global_index
from lexistat.session import stage

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BITS = 24


def offset(source: Column) -> Column:
    """The random start of a source, 0 to 2**24 - 1, fixed by its name; null has its own."""
    name = F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))
    return F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``(source, source_size, rows, before, target, rate)``, one row per source.

    Weights go round the sources in code point order, null last. Targets share the sum of all
    sizes by weight; where that is over ``most`` times a source's size it stops there, and the rest is
    shared by the others. Sources are taken by the level at which they stop: the level that
    holds is the first one below the next source's stop. ``before`` counts the rows of the
    sources in front. A source or corpus without words has target 0. The windows run over one
    row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    circle = F.array(*map(F.lit, weights))
    weighed = totals.select(
        "source", "source_size", "rows",
        F.get(circle, (F.row_number().over(by_name) - 1) % len(weights)).alias("weight"),
        (F.sum("rows").over(by_name.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias("before"),
        (F.col("source_size") * most).alias("ceiling"),
    )
    by_stop = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    up_to = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(up_to), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up_to), F.lit(0))
    levels = weighed.withColumn("level", left / weight_left)
    holds = F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.col("level"))
    level = F.first(holds, ignorenulls=True).over(everything)
    target = F.least(F.col("ceiling").cast("double"), level * F.col("weight"))
    return levels.select(
        "source", "source_size", "rows", "before", F.coalesce(target, F.lit(0.0)).alias("target")
    ).withColumn(
        "rate",
        F.when(
            F.col("source_size") > 0,
            F.floor(F.col("target") / F.col("source_size") * (1 << BITS)),
        ).otherwise(F.lit(0)).cast("long"),
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per row of ``docs``.

    ``size`` counts the words of the whole text (null: 0), ``taken`` is ``size * copies``, and
    ``copies`` is at most ``most``. Empty texts may be taken; they add no words. Null sources are
    one source, ordered last. Repeated rows and repeated ids count as documents of their own and
    share copies in any order. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sizes = stage(
        docs.select("doc_id", "source", F.regexp_count(whole_text(), F.lit(SPACED)).cast("long").alias("size")),
        "sizes",
    )
    targets = stage(source_targets(sizes, weights, most), "targets")
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("doc_id").asc()]
    placed = global_index(sizes, order, "place", 1, usual_parts(spark))
    named = targets.withColumnRenamed("source", "of")
    start, rate, place = F.col("start"), F.col("rate"), F.col("place") - F.col("before")
    passed = F.shiftright(rate * place + start, BITS) - F.shiftright(rate * (place - 1) + start, BITS)
    joined = placed.join(named, placed["source"].eqNullSafe(named["of"])).withColumn(
        "start", offset(F.col("source"))
    )
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", passed.alias("copies"),
        (passed * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it; same columns.

    Copies meet their texts by id, source and size. Rows that agree in all three share the copies
    of their group evenly, the first in text order taking what is left over.
    """
    shares = stage(
        mix(docs, weights, most).groupBy("doc_id", "source", "size").agg(
            F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")
        ),
        "shares",
    )
    taken = shares.filter("_copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_words"),
        "_copies", "_rows",
    )
    rows = docs.select(
        row_of(docs), "doc_id", "source",
        F.regexp_count(whole_text(), F.lit(SPACED)).cast("long").alias("_size"),
    )
    same = (
        rows["doc_id"].eqNullSafe(taken["_id"])
        & rows["source"].eqNullSafe(taken["_source"])
        & (rows["_size"] == taken["_words"])
    )
    joined = rows.join(taken, same)
    if shares.filter("_rows > 1").limit(1).count():
        turn = Window.partitionBy("doc_id", "source", "_size").orderBy("_row.text")
        extra = F.row_number().over(turn) <= F.col("_copies") % F.col("_rows")
        joined = joined.withColumn(
            "_copies", F.floor(F.col("_copies") / F.col("_rows")) + extra.cast("long")
        ).filter("_copies > 0")
    repeats = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return joined.select("_row", repeats.alias("_copy")).select("_row.*")


SQL = f"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sizes GROUP BY source
), weighed AS (
    SELECT *, list_extract([{", ".join(map(str, WEIGHTS))}],
                           1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)})::INT) AS weight,
           source_size * {MOST_COPIES} AS ceiling
    FROM totals
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER up_to, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER up_to, 0))::DOUBLE AS level,
           row_number() OVER (ORDER BY ceiling / weight, source NULLS LAST) AS turn
    FROM weighed
    WINDOW up_to AS (ORDER BY ceiling / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), held AS (
    SELECT arg_min(level, turn) AS level FROM levels WHERE level * weight <= ceiling
), targets AS (
    SELECT source, source_size,
           coalesce(least(ceiling::DOUBLE, (SELECT level FROM held) * weight), 0) AS target
    FROM levels
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * {1 << BITS})::BIGINT ELSE 0 END AS rate,
           ('0x' || substr(md5(coalesce('s' || source, 'null')), 1, {BITS // 4}))::BIGINT AS start
    FROM targets
), places AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS place FROM sizes
), passed AS (
    SELECT p.doc_id, p.size, r.source_size, r.target,
           ((rate * place + start) >> {BITS}) - ((rate * (place - 1) + start) >> {BITS}) AS copies
    FROM places p JOIN rates r ON p.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken FROM passed
"""
