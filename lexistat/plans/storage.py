"""Round trips: derived tables are written in the formats of the library and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions import html
from lexistat.operators import records, terms
from lexistat.plans import retrieval, sql
from lexistat.plans.crawl import PAGE_HREF
from lexistat.plans.statistics import SIGNALS_SQL
from lexistat.session import own_folder
from lexistat.sources import publications
from lexistat.sources.tables import portal_pages, signals, table
from lexistat.streaming import seen
from lexistat.streaming.snapshot import land

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _folder(spark: SparkSession, name: str) -> str:
    return f"{own_folder(spark, 'round-trip')}/{name}"


def publications_json(spark: SparkSession, folder: str) -> DataFrame:
    """Records as JSON lines, which split, and back."""
    path = _folder(spark, "publications")
    publications.write_publications(
        records.parse_publications(portal_pages(spark, folder), "page_id"), path, "json"
    )
    read = publications.read_publications(spark, path, multi_line=False)
    return read.select("id", "title", "year", "month", "day", "abstract", "detail", "link")


QUERIES["publications_json"] = publications_json
ORACLES["publications_json"] = f"""
WITH {sql.PUBLICATIONS} SELECT id, title, year, month, day, abstract, detail, link FROM pub
"""


def postings_json(spark: SparkSession, folder: str) -> DataFrame:
    """The inverted index as JSON in folders by first character, and back."""
    clean = terms.cleaned(table(spark, folder, "documents"), block=retrieval.BLOCK)
    counts = terms.term_counts(clean, F.split("clean", " "), carry=("block",))
    lists = terms.postings(counts, block=retrieval.BLOCK)
    path = _folder(spark, "postings")
    publications.write_postings(lists, path)
    read = spark.read.schema("term string, block bigint, postings array<bigint>").json(path)
    ids = F.transform("postings", lambda i: i.cast("string"))
    return read.select("term", "block", F.array_join(ids, ",").alias("postings"))


QUERIES["postings_json"] = postings_json
ORACLES["postings_json"] = retrieval.ORACLES["inverted_index"]


def signals_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The signals file by position, with its output last."""
    path = _folder(spark, "signals")
    named = signals(spark, folder).withColumnRenamed("y", "x2")
    named.select(*publications.SIGNAL_FILE_COLUMNS).write.option("header", True).csv(path)
    return publications.read_signals(spark, path).withColumn("x3", F.round("x3", 6))


QUERIES["signals_csv"] = signals_csv
ORACLES["signals_csv"] = f"WITH {SIGNALS_SQL} SELECT x1, round(x3, 6) AS x3, x4, x5, y FROM sig"


def landed_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Portal entries and plain pages landed by streams: records on one side, rejects on the other."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    portal = portal_pages(spark, folder).select((-F.col("page_id") - 1).alias("page_id"), "url", "html")
    source = _folder(spark, "pages")
    pages.unionByName(portal).write.parquet(source)
    targets = {outcome: _folder(spark, outcome) for outcome in ("accepted", "rejected")}
    land(spark, source, *targets.values(), _folder(spark, "progress")).awaitTermination()
    accepted, rejected = (
        spark.read.schema(publications.PUBLICATION).parquet(target).select("id", F.lit(outcome).alias("outcome"))
        for outcome, target in targets.items()
    )
    return accepted.unionByName(rejected)


QUERIES["landed_snapshot"] = landed_snapshot
ORACLES["landed_snapshot"] = """
SELECT -page_id - 1 AS id, 'accepted' AS outcome FROM pages
UNION ALL SELECT page_id, 'rejected' FROM pages
"""


def landed_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Links of all pages in two landings, of odd pages and then of even ones: which brings a URL first."""
    found = table(spark, folder, "pages").select(
        "page_id", F.posexplode(html.all_groups(F.col("html"), PAGE_HREF)).alias("place", "url")
    )
    source, seen_urls, progress = (_folder(spark, name) for name in ("links", "seen", "seen-progress"))
    for odd in (1, 0):
        found.where(F.abs("page_id") % 2 == odd).write.mode("append").parquet(source)
        seen.land_urls(spark, source, seen_urls, progress).awaitTermination()
    return seen.seen(spark, seen_urls).select("url", "page_id", "place", "batch")


QUERIES["landed_urls"] = landed_urls
ORACLES["landed_urls"] = f"""
WITH a AS (SELECT page_id, regexp_extract_all(html, '{PAGE_HREF}', 1) AS u FROM pages),
e AS (SELECT page_id, unnest(u) AS url, (generate_subscripts(u, 1) - 1)::INT AS place FROM a),
r AS (SELECT *, 1 - abs(page_id) % 2 AS batch,
             row_number() OVER (PARTITION BY url ORDER BY abs(page_id) % 2 DESC, page_id, place) AS k FROM e)
SELECT url, page_id, place, batch FROM r WHERE k = 1
"""
