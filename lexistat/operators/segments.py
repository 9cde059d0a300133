"""An index that takes increments: segments that are added, hidden and merged, never rewritten.

A segment holds the term counts of its documents, its own document frequencies and its ids. A deletion is a
list of ids that are dead in all segments before it. A version lists the segments and deletions
that make up the index; it is written last, so an unfinished step is never read. Weights depend on the
frequencies of the whole corpus and are made when the index is read.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions.text import STOP_WORDS
from lexistat.operators.search import index_rows
from lexistat.operators.terms import cleaned, normalised
from lexistat.session import drop, stage

_VERSIONS = "parts array<int>, deletions array<int>, next int"


class Version(NamedTuple):
    """The segments and deletions of an index, and the number that the next one gets."""

    number: int
    parts: tuple[int, ...]
    deletions: tuple[int, ...]
    next: int


def version(spark: SparkSession, folder: str) -> Version:
    """The latest version; an index that has none yet is empty."""
    spark.createDataFrame([], f"{_VERSIONS}, number int").write.mode("append").partitionBy("number").parquet(
        f"{folder}/versions"
    )
    rows = spark.read.schema(f"{_VERSIONS}, number int").parquet(f"{folder}/versions")
    last = rows.orderBy(F.desc("number")).limit(1).collect()
    if not last:
        return Version(0, (), (), 1)
    return Version(last[0]["number"], tuple(last[0]["parts"]), tuple(last[0]["deletions"]), last[0]["next"])


def _commit(spark: SparkSession, folder: str, new: Version) -> None:
    row = spark.createDataFrame([(list(new.parts), list(new.deletions), new.next)], _VERSIONS)
    row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/versions/number={new.number}")


def _write(rows: DataFrame, folder: str, kind: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/{kind}/part={number}")


def _read(spark: SparkSession, folder: str, kind: str, numbers: Iterable[int], like: str) -> DataFrame:
    """The listed parts of one kind with their number; no rows if none is listed."""
    paths = [f"{folder}/{kind}/part={n}" for n in numbers]
    if not paths:
        return spark.createDataFrame([], f"{like}, part int")
    return spark.read.option("basePath", f"{folder}/{kind}").parquet(*paths)


def _frequencies(counts: DataFrame) -> DataFrame:
    return counts.where("tf > 0").groupBy("term").agg(F.count("*").alias("df"))


def add(
    docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id",
    stop_words: Iterable[str] = STOP_WORDS, lemmas: DataFrame | None = None,
) -> int:
    """Add a segment for ``docs``; its number. Ids must be new or deleted before."""
    spark = docs.sparkSession
    now = version(spark, folder)
    number = now.next
    clean = cleaned(docs, text, key, stop_words, lemmas, place=True)
    _write(index_rows(clean, key), folder, "counts", number)
    counts = _read(spark, folder, "counts", [number], "")
    _write(_frequencies(counts), folder, "frequencies", number)
    _write(docs.select(key), folder, "ids", number)
    _commit(spark, folder, Version(now.number + 1, (*now.parts, number), now.deletions, number + 1))
    return number


def delete(ids: DataFrame, folder: str, key: str = "doc_id") -> int:
    """Hide documents of the segments so far; the number of the deletion."""
    spark = ids.sparkSession
    now = version(spark, folder)
    _write(ids.select(key).where(F.col(key).isNotNull()).distinct(), folder, "deleted", now.next)
    _commit(spark, folder, Version(now.number + 1, now.parts, (*now.deletions, now.next), now.next + 1))
    return now.next


def _dead(spark: SparkSession, folder: str, now: Version, key: str) -> DataFrame:
    """``(key, before)``: the ids that are dead in all segments of a smaller number."""
    listed = _read(spark, folder, "deleted", now.deletions, f"`{key}` bigint")
    return listed.groupBy(key).agg(F.max("part").alias("before"))


def _split(rows: DataFrame, dead: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of living documents, and those of the dead."""
    found = rows.alias("r")
    hidden = (F.col(f"r.{key}") == F.col(f"d.{key}")) & (F.col("r.part") < F.col("d.before"))
    return found.join(dead.alias("d"), hidden, "left_anti"), found.join(dead.alias("d"), hidden, "left_semi")


def _living(spark: SparkSession, folder: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(counts, ids, frequencies)`` of the living documents of the latest version."""
    now = version(spark, folder)
    dead = _dead(spark, folder, now, key)
    kind = f"`{key}` bigint"
    counts, gone = _split(
        _read(spark, folder, "counts", now.parts, f"{kind}, term string, n bigint, tf bigint"), dead, key
    )
    ids, _ = _split(_read(spark, folder, "ids", now.parts, kind), dead, key)
    stored = _read(spark, folder, "frequencies", now.parts, "term string, df bigint").select("term", "df")
    # Frequencies are added up over the segments; only the rows of dead documents are counted again.
    lost = _frequencies(gone).select("term", (-F.col("df")).alias("df"))
    merged = stored.unionByName(lost).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    return counts.drop("part"), ids.drop("part"), merged


def read(spark: SparkSession, folder: str, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``(index, idf)`` as a fresh index over the living documents has them."""
    counts, ids, merged = _living(spark, folder, key)
    n = ids.agg(F.count(key).alias("n")).scalar()
    idf = stage(merged.withColumn("idf", F.ln((n + 1) / (F.col("df") + 1)) + 1), "idf")
    return normalised(counts, idf.select("term", "idf"), key, "left"), idf


def compact(spark: SparkSession, folder: str, key: str = "doc_id") -> int:
    """Merge all segments into one without the dead documents; its number.

    The old parts go after the new version is written; a reader that has begun on them must be done.
    """
    now = version(spark, folder)
    counts, ids, merged = _living(spark, folder, key)
    for kind, rows in (("counts", counts), ("ids", ids), ("frequencies", merged)):
        _write(rows, folder, kind, now.next)
    _commit(spark, folder, Version(now.number + 1, (now.next,), (), now.next + 1))
    for number in now.parts:
        for kind in ("counts", "ids", "frequencies"):
            drop(spark, f"{folder}/{kind}/part={number}")
    for number in now.deletions:
        drop(spark, f"{folder}/deleted/part={number}")
    return now.next
