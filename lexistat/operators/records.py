"""Publication records out of crawled portal pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexistat.functions import bibtex, html, shaping
from lexistat.sources.publications import ACCEPTED_FIELDS


def result_cards(pages: DataFrame, keys: list[str], text: str = "html") -> DataFrame:
    """``(keys, place, name, link)``: title text and link of each result on a listing page."""
    titles = F.transform(html.elements(F.col(text), html.CARD_TITLE), lambda t: F.get(html.links(t), F.lit(0)))
    cards = F.filter(titles, lambda card: card.isNotNull())
    return pages.select(*keys, F.posexplode(cards).alias("place", "card")).select(
        *keys, "place", "card.name", "card.link"
    )


def parse_publications(pages: DataFrame, key: str, text: str = "html") -> DataFrame:
    """One record per publication page, in the publication schema; what is missing is NULL."""
    # Every page is read once for all its marks, and its BibTeX once for all fields.
    marks = (html.PERSONS, html.RENDERED, html.BIBTEX, html.CARD_TITLE, html.BADGE)
    found = pages.select(F.col(key).alias("id"), html.marked(F.col(text), marks).alias("found"))

    def first(mark: int) -> Column:
        return F.nullif(F.get(html.inner(F.col("found"), mark), F.lit(0)), F.lit(""))

    parts = found.select(
        "id",
        first(0).alias("persons"),
        first(1).alias("rendered"),
        first(2).alias("bibtex"),
        first(3).alias("card"),
        html.inner(F.col("found"), 4).alias("badges"),
    )
    read = parts.select(
        "id",
        html.plain_text(F.col("persons")).alias("names"),
        html.links(F.col("persons")).alias("anchors"),
        bibtex.fields(html.unescape(html.without_tags(F.col("bibtex")))).alias("fields"),
        html.detail_and_output(html.plain_text(F.col("rendered"))).alias("lines"),
        F.get(html.links(F.col("card")), F.lit(0))["link"].alias("link"),
        F.transform("badges", html.plain_text).alias("concepts"),
    )
    field = {name: bibtex.value_of(F.col("fields"), name) for name in (*bibtex.FIELDS, "author")}
    return read.select(
        "id",
        field["title"].alias("title"),
        html.authors_from_text(F.col("names"), F.col("anchors")).alias("authors"),
        field["author"].alias("author"),
        field["year"].alias("year"),
        field["month"].alias("month"),
        field["day"].alias("day"),
        field["abstract"].alias("abstract"),
        F.col("lines.detail").alias("detail"),
        F.col("lines.output").alias("output"),
        "link",
        "concepts",
    )


def accepted_and_rejected(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with at least one detail field, and those with none.

    Both parts read ``records``: hand in a table, not an unparsed page set.
    """
    empty = F.lit(True)
    for name in ACCEPTED_FIELDS:
        empty = empty & F.col(name).isNull()
    return records.where(~empty), records.where(empty)


def with_author_list(records: DataFrame) -> DataFrame:
    """``authors`` filled from the older `` and ``-joined ``author`` where it is missing."""
    return records.withColumn(
        "authors", F.coalesce("authors", bibtex.authors(F.col("author")))
    )


def shaped(records: DataFrame) -> DataFrame:
    """Records as the result page shows them."""
    date = shaping.date_text(F.col("day"), F.col("month"), F.col("year"))
    return records.withColumn("date", date).select(
        "id",
        shaping.latex_title(F.col("title")).alias("title"),
        shaping.author_line(F.col("authors")).alias("authors"),
        "detail",
        "date",
        shaping.journal(F.col("detail"), F.col("date")).alias("journal"),
        F.col("output").alias("type"),
        shaping.link_or_hash(F.col("link")).alias("link"),
        shaping.concept_tags(F.col("concepts")).alias("tags"),
    )
