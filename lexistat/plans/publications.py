"""Publication records parsed from portal entries, and the shapes they are shown in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions import bibtex, html, shaping
from lexistat.operators import records, search
from lexistat.plans import sql
from lexistat.session import stage
from lexistat.sources.tables import portal_pages

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

LISTED = ["The", "En", "and", "Nicht", "de", "en Group", "fr Group"]
LISTED_SQL = ", ".join(f"'{name}'" for name in LISTED)
WANTED = "tion"


def _portal(spark: SparkSession, folder: str) -> DataFrame:
    return portal_pages(spark, folder)


def _publications(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed once and written; every shape below reads that table."""
    return stage(records.parse_publications(_portal(spark, folder), "page_id"), "publications")


def _exploded(df: DataFrame) -> DataFrame:
    return df.select("id", F.posexplode("authors").alias("place", "a")).select(
        "id", "place", "a.name", "a.link"
    )


def _exploded_sql(source: str) -> str:
    return f"""e AS (SELECT id, unnest(authors) AS a, (generate_subscripts(authors, 1) - 1)::INT AS place
       FROM {source})
SELECT id, place, a.name AS name, a.link AS link FROM e"""


def bibtex_fields(spark: SparkSession, folder: str) -> DataFrame:
    return _publications(spark, folder).select("id", "title", "year", "month", "day", "abstract")


QUERIES["bibtex_fields"] = bibtex_fields
ORACLES["bibtex_fields"] = f"""
WITH {sql.PUBLICATIONS} SELECT id, title, year, month, day, abstract FROM pub
"""


def bibtex_quoted(spark: SparkSession, folder: str) -> DataFrame:
    """Fields in quotes and the bare month, as they stand: entries in braces have only the latter."""
    bib = html.unescape(html.first_element(F.col("html"), html.BIBTEX))
    read = _portal(spark, folder).select("page_id", bibtex.fields(bib).alias("fields"))
    fields = F.col("fields")
    return read.select(
        "page_id",
        *[bibtex.value_of(fields, f, bibtex.QUOTED, "raw").alias(f) for f in ("title", "year", "day", "abstract")],
        bibtex.value_of(fields, "month", bibtex.BARE).alias("month"),
    )


QUERIES["bibtex_quoted"] = bibtex_quoted
ORACLES["bibtex_quoted"] = f"""
WITH {sql.PUBLICATIONS}
SELECT page_id, {', '.join(f"""nullif(regexp_extract(bib, '(?s),{chr(92)}s*{f}{chr(92)}s*={chr(92)}s*"(.*?)"{chr(92)}s*,', 1), '') AS {f}"""
                           for f in ('title', 'year', 'day', 'abstract'))},
       nullif(regexp_extract(bib, ',\\s*month\\s*=\\s*([a-z]+)\\s*,', 1), '') AS month
FROM cut
"""


def author_links(spark: SparkSession, folder: str) -> DataFrame:
    return _exploded(_publications(spark, folder))


QUERIES["author_links"] = author_links
ORACLES["author_links"] = f"WITH {sql.PUBLICATIONS}, {_exploded_sql('pub')}"


def author_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """Authors by their anchors alone: names without a link are left out."""
    people = html.links(html.first_element(F.col("html"), html.PERSONS))
    return _portal(spark, folder).select(
        F.col("page_id").alias("id"), F.posexplode(people).alias("place", "a")
    ).select("id", "place", "a.name", "a.link")


QUERIES["author_anchors"] = author_anchors
ORACLES["author_anchors"] = f"""
WITH {sql.PORTAL}, flat AS (SELECT page_id AS id, anchors AS authors FROM base), {_exploded_sql('flat')}
"""


def bibtex_authors(spark: SparkSession, folder: str) -> DataFrame:
    older = _publications(spark, folder).select("id", bibtex.authors(F.col("author")).alias("authors"))
    return _exploded(older).select("id", "place", "name")


QUERIES["bibtex_authors"] = bibtex_authors
ORACLES["bibtex_authors"] = f"""
WITH {sql.PUBLICATIONS},
s AS (SELECT id, string_split(author, ' and ') AS names FROM pub),
e AS (SELECT id, unnest(names) AS n, (generate_subscripts(names, 1) - 1)::INT AS place FROM s)
SELECT id, place, trim(regexp_replace(n, '[{{}}]', '', 'g')) AS name FROM e
"""


def detail_output_split(spark: SparkSession, folder: str) -> DataFrame:
    return _publications(spark, folder).select("id", "detail", "output")


QUERIES["detail_output_split"] = detail_output_split
ORACLES["detail_output_split"] = f"""
WITH {sql.PORTAL}
SELECT page_id AS id, {sql.unescape('detail')} AS detail, 'Research output: ' || lang AS output FROM base2
"""


def concepts_split(spark: SparkSession, folder: str) -> DataFrame:
    tags = shaping.concept_tags(F.col("concepts"))
    return _publications(spark, folder).select("id", F.posexplode(tags).alias("place", "t")).select(
        "id", "place", "t.name", "t.pct"
    )


QUERIES["concepts_split"] = concepts_split
ORACLES["concepts_split"] = f"""
WITH {sql.PORTAL},
e AS (SELECT page_id AS id, unnest(names) AS n, (generate_subscripts(names, 1) - 1)::INT AS place FROM base)
SELECT id, place, {sql.unescape('n')} AS name, 100 - 10 * place AS pct FROM e
"""


def latex_title(spark: SparkSession, folder: str) -> DataFrame:
    title = shaping.latex_title(F.concat(F.lit("{On}  {\\textquoteright}"), "title", F.lit("{ \\textquotedblright}")))
    return _publications(spark, folder).select("id", title.alias("title"))


QUERIES["latex_title"] = latex_title
ORACLES["latex_title"] = f"""
WITH {sql.PUBLICATIONS}
SELECT id, trim(regexp_replace('On ''' || regexp_replace(replace(replace(replace(title, '{{\\&}}', '&'),
         '\\$', '$'), '\\%', '%'), '[{{}}]', '', 'g') || '"', '\\s+', ' ', 'g')) AS title
FROM pub
"""

DATED = f"""{sql.PUBLICATIONS},
dated AS (SELECT *, coalesce(day, '') || ' ' || upper(month[1]) || month[2:] || ' ' || coalesce(year, '') AS date
          FROM pub)"""


def date_text(spark: SparkSession, folder: str) -> DataFrame:
    date = shaping.date_text(F.col("day"), F.col("month"), F.col("year"))
    return _publications(spark, folder).select("id", date.alias("date"))


QUERIES["date_text"] = date_text
ORACLES["date_text"] = f"WITH {DATED} SELECT id, date FROM dated"


def journal_text(spark: SparkSession, folder: str) -> DataFrame:
    return records.shaped(_publications(spark, folder)).select("id", "journal")


QUERIES["journal_text"] = journal_text
ORACLES["journal_text"] = f"""
WITH {DATED}
SELECT id, CASE WHEN len(string_split(detail, date || ',')) = 2
                THEN string_split(detail, date || ',')[2] ELSE detail END AS journal FROM dated
"""


def author_html(spark: SparkSession, folder: str) -> DataFrame:
    return records.shaped(_publications(spark, folder)).select("id", "authors")


AUTHOR_LINE = """array_to_string(list_transform(authors, lambda a: CASE WHEN a.link <> ''
  THEN '<a target="_blank" href="' || a.link || '">' || a.name || '</a>' ELSE a.name END), ', ')"""
QUERIES["author_html"] = author_html
ORACLES["author_html"] = f"WITH {sql.PUBLICATIONS} SELECT id, {AUTHOR_LINE} AS authors FROM pub"


def shape_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Links of the outsiders are blank, access lists are absent: both get their default."""
    people = shaping.listed_links_only(F.col("authors"), LISTED)
    flat = _exploded(_publications(spark, folder).select("id", people.alias("authors")))
    absent = F.lit(None).cast("array<string>")
    return flat.select(
        "id", "place", shaping.link_or_hash(F.col("link")).alias("link"),
        F.size(shaping.list_or_empty(absent)).alias("access"),
    )


QUERIES["shape_defaults"] = shape_defaults
ORACLES["shape_defaults"] = f"""
WITH {sql.PUBLICATIONS},
e AS (SELECT id, unnest(authors) AS a, (generate_subscripts(authors, 1) - 1)::INT AS place FROM pub)
SELECT id, place, CASE WHEN a.name IN ({LISTED_SQL}) AND a.link <> '' THEN a.link ELSE '#' END AS link,
       0 AS access
FROM e
"""


def any_field_filter(spark: SparkSession, folder: str) -> DataFrame:
    shown = records.shaped(_publications(spark, folder))
    wanted = shaping.any_field_contains(
        WANTED, title=F.col("title"), authors=F.col("authors"), journal=F.col("journal"),
        tags=F.col("tags"),
    )
    return shown.where(wanted).select("id")


QUERIES["any_field_filter"] = any_field_filter
ORACLES["any_field_filter"] = f"""
WITH {DATED}
SELECT id FROM dated
WHERE contains(lower(regexp_replace(title, '[{{}}\\\\]', '', 'g')), '{WANTED}')
   OR contains(lower({AUTHOR_LINE}), '{WANTED}')
   OR contains(lower(CASE WHEN len(string_split(detail, date || ',')) = 2
                     THEN string_split(detail, date || ',')[2] ELSE detail END), '{WANTED}')
   OR len(list_filter(concepts, lambda c: contains(lower(string_split(c, chr(10))[1]), '{WANTED}'))) > 0
"""


def author_whitelist(spark: SparkSession, folder: str) -> DataFrame:
    people = shaping.listed_links_only(F.col("authors"), LISTED)
    return _exploded(_publications(spark, folder).select("id", people.alias("authors")))


QUERIES["author_whitelist"] = author_whitelist
ORACLES["author_whitelist"] = f"""
WITH {sql.PUBLICATIONS},
e AS (SELECT id, unnest(authors) AS a, (generate_subscripts(authors, 1) - 1)::INT AS place FROM pub)
SELECT id, place, a.name AS name, CASE WHEN a.name IN ({LISTED_SQL}) THEN a.link ELSE '' END AS link
FROM e
"""


def search_text(spark: SparkSession, folder: str) -> DataFrame:
    text = shaping.search_text(F.col("title"), F.col("authors"), LISTED)
    return _publications(spark, folder).select("id", text.alias("text"))


SEARCH_TEXT = f"""title || ' ' || array_to_string(list_transform(
  list_filter(authors, lambda a: a.name IN ({LISTED_SQL})), lambda a: a.name), ' ')"""
QUERIES["search_text"] = search_text
ORACLES["search_text"] = f"WITH {sql.PUBLICATIONS} SELECT id, {SEARCH_TEXT} AS text FROM pub"


def publication_search(spark: SparkSession, folder: str) -> DataFrame:
    """From portal pages to the first page of shown results, for one query."""
    pubs = _publications(spark, folder)
    linked = pubs.withColumn("authors", shaping.listed_links_only(F.col("authors"), LISTED))
    texts = pubs.select("id", shaping.search_text(F.col("title"), F.col("authors"), LISTED).alias("text"))
    index, idf = search.build_index(texts, key="id")
    found, _ = search.search(linked, index, idf, "Tion thndnt de Group", key="id")
    return records.shaped(found).select("id", "title", "authors", "date", "journal", "type", "link")


QUERIES["publication_search"] = publication_search
ORACLES["publication_search"] = f"""
WITH {DATED},
documents AS (SELECT id AS doc_id, {SEARCH_TEXT} AS text FROM pub),
{sql.INDEX},
{sql.queries("SELECT 1 AS query_id, 'Tion thndnt de Group' AS query")},
shown AS (SELECT *, list_transform(authors, lambda a: {{'name': a.name,
            'link': CASE WHEN a.name IN ({LISTED_SQL}) THEN a.link ELSE '' END}}) AS shown FROM dated)
SELECT id, trim(regexp_replace(regexp_replace(replace(replace(replace(title, '{{\\&}}', '&'), '\\$', '$'),
         '\\%', '%'), '[{{}}]', '', 'g'), '\\s+', ' ', 'g')) AS title,
       {AUTHOR_LINE.replace('authors', 'shown')} AS authors, date,
       CASE WHEN len(string_split(detail, date || ',')) = 2
            THEN string_split(detail, date || ',')[2] ELSE detail END AS journal,
       output AS type, coalesce(nullif(link, ''), '#') AS link
FROM rk JOIN shown ON rk.doc_id = shown.id WHERE rank <= {search.PAGE_SIZE}
"""
