"""The landed tables and what is derived from them: signals, portal pages, robots texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions import html, shaping
from lexistat.session import spread, stage

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def signals(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, x1, x3, x4, x5, y)`` measured on the texts, staged.

    x1 length, x3 characters per word, x4 lines, x5 commas, y distinct words. The texts are read
    once; the studies then run over six narrow columns.
    """
    docs = spread(table(spark, folder, "documents").select("doc_id", "text", "n_chars"), "doc_id")
    text = F.col("text")
    words = F.filter(F.split(F.lower(text), "[ \t\n\r]+"), lambda w: w != "")
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    measured = docs.select("doc_id", "n_chars", "text", words.alias("words")).select(
        "doc_id",
        F.col("n_chars").cast("double").alias("x1"),
        (F.length(text) / F.greatest(F.size("words"), F.lit(1))).alias("x3"),
        lines.cast("double").alias("x4"),
        commas.cast("double").alias("x5"),
        F.size(F.array_distinct("words")).cast("double").alias("y"),
    )
    return stage(measured, "signals")


def _latex(text: Column) -> Column:
    for plain, escaped in (("&", "{\\&}"), ("%", "\\%"), ("$", "\\$")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def portal_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, url, html)``: each landed page as an entry of a publication portal.

    Title, authors, citation line, concept badges, BibTeX block and pagination are made from the
    page's own title, links, language, number and whole text. French and Spanish entries write
    their BibTeX with braces, German ones have no day, English ones no number in the citation.
    """
    pages = spread(table(spark, folder, "pages"), "page_id")
    page = F.col("html")
    base = pages.select(
        "page_id",
        "url",
        html.page_title(page).alias("title"),
        html.links(page).alias("anchors"),
        F.regexp_extract(page, '<html lang="([a-z]+)"', 1).alias("lang"),
        html.plain_text(page).alias("text"),
        F.coalesce(
            html.first_group(F.col("url"), "/[a-z][a-z]/([0-9]+)").try_cast("int"), F.lit(0)
        ).alias("number"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
    )
    number = F.col("number")
    day = F.when(F.col("lang") != "de", (number % 28 + 1).cast("string"))
    month = F.get(F.array(*map(F.lit, MONTHS)), number % 12)
    year = (number % 26 + 2000).cast("string")
    dated = base.select("*", day.alias("day"), month.alias("month"), year.alias("year"))
    names = F.transform("anchors", lambda a: a["name"])
    braced = F.col("lang").isin("fr", "es")
    opening = F.when(braced, "{").otherwise('"')
    closing = F.when(braced, "},\n").otherwise('",\n')

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"  {name} = "), opening, value, closing)

    bib = F.concat(
        F.lit("@article{p"), F.col("page_id").cast("string"), F.lit(",\n"),
        field("title", _latex(F.col("title"))),
        field("author", F.array_join(names, " and ")),
        field("year", F.col("year")),
        F.lit("  month = "), F.col("month"), F.lit(",\n"),
        F.coalesce(field("day", F.col("day")), F.lit("")),
        field("abstract", F.col("text")),
        F.lit("}"),
    )
    when = F.trim(shaping.date_text(F.col("day"), F.col("month"), F.col("year")))
    detail = F.concat(
        F.array_join(names, ", "), F.lit(", "), when, F.lit(", In: "), F.col("host"),
        F.when(F.col("lang") != "en", F.concat(F.lit(". "), number.cast("string"))).otherwise(""),
    )
    persons = F.transform(
        "anchors",
        lambda a: F.concat(F.lit('<a href="'), a["link"], F.lit('">'), a["name"], F.lit("</a>")),
    )
    badges = F.transform(
        names,
        lambda name, i: F.concat(
            F.lit('<span class="concept-badge-small-container">'), name, F.lit("\n"),
            (100 - 10 * i).cast("string"), F.lit("%</span>"),
        ),
    )
    steps = F.transform(
        F.sequence(F.lit(1), number % 9 + 1),
        lambda i: F.concat(F.lit('<a class="step">'), i.cast("string"), F.lit("</a>")),
    )
    entry = F.concat(
        F.lit('<div class="result-container"><h3 class="title"><a href="'), F.col("url"),
        F.lit('">'), F.col("title"), F.lit('</a></h3><p class="relations persons">'),
        F.array_join(persons, ", "), F.lit(", "), F.col("lang"),
        F.lit(' Group</p><div class="rendering_researchoutput">'), F.col("title"), F.lit("\n"),
        detail, F.lit("\nResearch output: "), F.col("lang"), F.lit("</div>"),
        F.array_join(badges, ""), F.lit('<pre class="rendering_researchoutput_bibtex">'), bib,
        F.lit('</pre></div><nav class="pages">'),
        F.when(number % 9 > 0, F.array_join(steps, "")).otherwise(""), F.lit("</nav>"),
    )
    return dated.select("page_id", "url", entry.alias("html"))


def robots_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, site, text)``: a robots text for each landed page, made from its URL."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    site = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    path = F.regexp_replace(F.regexp_extract("url", "^https?://[^/]+(/.*)$", 1), "[?#].*$", "")
    number = html.first_group(F.col("url"), "/[a-z][a-z]/([0-9]+)")
    text = F.concat(
        F.lit("User-agent: *\nDISALLOW: "), path, F.lit("*ref=\nDisallow:\ndisallow: /*?*page=\n"),
        F.coalesce(F.concat(F.lit("Crawl-delay: 1\r\ncrawl-Delay: "), number, F.lit("\n")), F.lit("")),
        F.lit("Sitemap: "), site, F.lit("/sitemap/pages.xml\n  sitemap: "), site,
        F.lit("/sitemap/other.xml"),
    )
    return pages.select("page_id", site.alias("site"), text.alias("text"))
