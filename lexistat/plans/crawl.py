"""Extraction from the landed ``pages`` and URL filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions import html
from lexistat.operators import records, urls
from lexistat.plans import sql
from lexistat.session import spread, stage
from lexistat.sources.tables import portal_pages, robots_texts, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

RULES = ["/*?*utm_source=", "/fr/*.html", "", "*cheap-pills*", "/en/1", "spam-farm.example"]
URL_PATTERN = r"https?://[^\s\"'<>]+"
# The same where URLs may follow each other without anything between.
JOINED_URL_PATTERN = r"https?://(?:(?!https?://)[^\s\"'<>])+"
PAGE_HREF = r'href="(/[^"]*)"'


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages"), "page_id")


def page_title(spark: SparkSession, folder: str) -> DataFrame:
    heading = html.unescape(html.first_group(F.col("html"), "<h1[^>]*>([^<]*)</h1>"))
    return _pages(spark, folder).select(
        "page_id", html.page_title(F.col("html")).alias("title"), heading.alias("heading")
    )


QUERIES["page_title"] = page_title
ORACLES["page_title"] = f"""
SELECT page_id,
       nullif({sql.unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, '') AS title,
       nullif({sql.unescape("regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)")}, '') AS heading
FROM pages
"""


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    found = F.posexplode(html.links(F.col("html"))).alias("place", "anchor")
    return _pages(spark, folder).select("page_id", found).select(
        "page_id", "place", "anchor.name", "anchor.link"
    )


QUERIES["page_links"] = page_links
ORACLES["page_links"] = f"""
WITH a AS (SELECT page_id, {sql.links('html')} AS anchors FROM pages),
e AS (SELECT page_id, unnest(anchors) AS anchor, (generate_subscripts(anchors, 1) - 1)::INT AS place FROM a)
SELECT page_id, place, anchor.name AS name, anchor.link AS link FROM e
"""


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("page_id", html.plain_text(F.col("html")).alias("text"))


QUERIES["page_text"] = page_text
ORACLES["page_text"] = f"SELECT page_id, {sql.plain_text('html')} AS text FROM pages"


def result_cards(spark: SparkSession, folder: str) -> DataFrame:
    return records.result_cards(portal_pages(spark, folder), ["page_id"])


QUERIES["result_cards"] = result_cards
ORACLES["result_cards"] = f"""
WITH {sql.PORTAL}
SELECT page_id, 0 AS place, trim({sql.unescape('title')}) AS name, url AS link FROM base2
"""


def last_page_number(spark: SparkSession, folder: str) -> DataFrame:
    portal = portal_pages(spark, folder)
    return portal.select("page_id", html.last_page(F.col("html")).alias("last_page"))


QUERIES["last_page_number"] = last_page_number
ORACLES["last_page_number"] = f"""
WITH {sql.PORTAL}
SELECT page_id, CASE WHEN number % 9 = 0 THEN 0 ELSE number % 9 + 1 END AS last_page FROM base2
"""


def pagination_urls(spark: SparkSession, folder: str) -> DataFrame:
    portal = portal_pages(spark, folder)
    listing = html.page_urls(F.col("url"), html.last_page(F.col("html")))
    return portal.select("page_id", F.explode(listing).alias("page_url"))


QUERIES["pagination_urls"] = pagination_urls
ORACLES["pagination_urls"] = f"""
WITH {sql.PORTAL}
SELECT page_id, url || '?page=' || unnest(range(0,
         CASE WHEN number % 9 = 0 THEN 1 ELSE number % 9 + 1 END)) AS page_url
FROM base2
"""


def url_extract_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Link targets of all pages, each with the page and place where it comes first."""
    found = _pages(spark, folder).select(
        "page_id", F.posexplode(html.all_groups(F.col("html"), PAGE_HREF)).alias("place", "url")
    )
    return urls.first_seen(found, ["page_id", "place"])


QUERIES["url_extract_distinct"] = url_extract_distinct
ORACLES["url_extract_distinct"] = f"""
WITH a AS (SELECT page_id, regexp_extract_all(html, '{PAGE_HREF}', 1) AS u FROM pages),
e AS (SELECT page_id, unnest(u) AS url, (generate_subscripts(u, 1) - 1)::INT AS place FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, place) AS k FROM e)
SELECT url, page_id, place FROM r WHERE k = 1
"""


def robots_directives(spark: SparkSession, folder: str) -> DataFrame:
    read = robots_texts(spark, folder).select(
        "page_id", html.robots_directives(F.col("text")).alias("d")
    )
    return read.select(
        "page_id", "d.crawl_delay", "d.sitemap", F.array_join("d.rules", " ").alias("rules")
    )


QUERIES["robots_directives"] = robots_directives
ORACLES["robots_directives"] = r"""
SELECT page_id,
       coalesce(try_cast(regexp_extract(url, '/[a-z][a-z]/([0-9]+)', 1) AS INT), 5) AS crawl_delay,
       regexp_extract(url, '^(https?://[^/]+)', 1) || '/sitemap/pages.xml' AS sitemap,
       regexp_replace(regexp_extract(url, '^https?://[^/]+(/.*)$', 1), '[?#].*$', '')
         || '*ref= /*?*page=' AS rules
FROM pages
"""


def url_allowed(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.allowed(pages, RULES)


QUERIES["url_allowed"] = url_allowed
ORACLES["url_allowed"] = r"""
SELECT page_id, url FROM pages
WHERE NOT regexp_matches(url, '/.*\?.*utm_source=') AND NOT regexp_matches(url, '/fr/.*\.html')
  AND NOT contains(url, 'cheap-pills') AND NOT contains(url, '/en/1')
  AND NOT contains(url, 'spam-farm.example')
"""


def _sitemap(spark: SparkSession, folder: str) -> DataFrame:
    """Sitemap URLs in crawl order: those the robots text of each page names."""
    return urls.extracted(robots_texts(spark, folder), "text", URL_PATTERN, ["page_id"])


SITEMAP_SQL = """
site AS (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS s FROM pages),
listed AS (SELECT page_id, 0 AS place, s || '/sitemap/pages.xml' AS url FROM site
           UNION ALL SELECT page_id, 1, s || '/sitemap/other.xml' FROM site)
"""


def url_first_match(spark: SparkSession, folder: str) -> DataFrame:
    return urls.first_match(
        _sitemap(spark, folder), "example.org", "other.xml", ["page_id", "place"]
    )


QUERIES["url_first_match"] = url_first_match
ORACLES["url_first_match"] = f"""
WITH {SITEMAP_SQL}
SELECT page_id, place, url FROM listed
WHERE contains(url, 'example.org') AND ends_with(url, 'other.xml') ORDER BY page_id, place LIMIT 1
"""


def url_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """URLs by pattern out of running text, every occurrence."""
    return _sitemap(spark, folder)


QUERIES["url_patterns"] = url_patterns
ORACLES["url_patterns"] = f"WITH {SITEMAP_SQL} SELECT page_id, place, url FROM listed"


def org_urls(spark: SparkSession, folder: str) -> DataFrame:
    found = urls.entries(_sitemap(spark, folder), "/sitemap", "pages")
    return urls.first_seen(found, ["page_id", "place"])


QUERIES["org_urls"] = org_urls
ORACLES["org_urls"] = f"""
WITH {SITEMAP_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, place) AS k
      FROM listed WHERE contains(url, '/sitemap/pages'))
SELECT url, page_id, place FROM r WHERE k = 1
"""


def _joined_sitemap(spark: SparkSession, folder: str) -> DataFrame:
    """URLs of a sitemap whose text has lost the space between them."""
    site = urls.site(F.col("url"))
    text = F.concat(site, F.lit("/sitemap/pages.xml"), site, F.lit("/sitemap/other.xml"))
    joined = table(spark, folder, "pages").select("page_id", text.alias("text"))
    return urls.extracted(joined, "text", JOINED_URL_PATTERN, ["page_id"])


def sitemap_urls(spark: SparkSession, folder: str) -> DataFrame:
    return _joined_sitemap(spark, folder)


QUERIES["sitemap_urls"] = sitemap_urls
ORACLES["sitemap_urls"] = f"WITH {SITEMAP_SQL} SELECT page_id, place, url FROM listed"


def target_url(spark: SparkSession, folder: str) -> DataFrame:
    """From the sitemap to the organisations' URLs, with the suffix, as far as allowed: the first one."""
    found = urls.entries(_joined_sitemap(spark, folder), "/sitemap", "pages")
    suffixed = urls.with_suffix(urls.first_seen(found, ["page_id", "place"]), "/publications", RULES)
    return urls.first_match(suffixed, "/sitemap", "/publications", ["page_id", "place"])


QUERIES["target_url"] = target_url
ORACLES["target_url"] = f"""
WITH {SITEMAP_SQL}
SELECT page_id, place, url || '/publications' AS url FROM listed
WHERE contains(url, '/sitemap/pages') AND NOT contains(url, 'cheap-pills')
  AND NOT contains(url, 'spam-farm.example')
ORDER BY page_id, place LIMIT 1
"""


def site_url_allowed(spark: SparkSession, folder: str) -> DataFrame:
    """The pages that the robots texts of their own sites allow."""
    texts = robots_texts(spark, folder).select("site", html.robots_directives(F.col("text")).alias("d"))
    rules = texts.select("site", F.explode("d.rules").alias("rule"))
    return urls.allowed_by_site(table(spark, folder, "pages").select("page_id", "url"), rules)


QUERIES["site_url_allowed"] = site_url_allowed
ORACLES["site_url_allowed"] = r"""
WITH site AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site FROM pages),
rules AS (SELECT DISTINCT site, regexp_replace(regexp_extract(url, '^https?://[^/]+(/.*)$', 1), '[?#].*$', '')
                 || '*ref=' AS rule FROM site
          UNION SELECT site, '/*?*page=' FROM site),
patterns AS (SELECT site, array_to_string(list_transform(string_split(rule, '*'), lambda x: regexp_escape(x)), '.*')
                    AS pattern FROM rules)
SELECT page_id, url FROM site s
WHERE NOT EXISTS (SELECT 1 FROM patterns p WHERE p.site = s.site AND regexp_matches(s.url, p.pattern))
"""


def suffixed_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.with_suffix(pages, "/publications", [*RULES, "html/publications"])


QUERIES["suffixed_urls"] = suffixed_urls
ORACLES["suffixed_urls"] = r"""
SELECT page_id, url || '/publications' AS url FROM pages
WHERE NOT regexp_matches(url, '/.*\?.*utm_source=') AND NOT regexp_matches(url, '/fr/.*\.html')
  AND NOT contains(url, 'cheap-pills') AND NOT contains(url, '/en/1')
  AND NOT contains(url, 'spam-farm.example') AND NOT ends_with(url, 'html')
"""


def page_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Landed pages and portal entries together: only the entries hold publication details."""
    pages = _pages(spark, folder).select("page_id", "html")
    portal = portal_pages(spark, folder).select((-F.col("page_id") - 1).alias("page_id"), "html")
    read = stage(records.parse_publications(pages.unionByName(portal), "page_id"), "parsed")
    accepted, rejected = records.accepted_and_rejected(read)
    return (
        accepted.select("id", F.lit("accepted").alias("outcome"))
        .unionByName(rejected.select("id", F.lit("rejected").alias("outcome")))
    )


QUERIES["page_rejects"] = page_rejects
ORACLES["page_rejects"] = """
SELECT -page_id - 1 AS id, 'accepted' AS outcome FROM pages
UNION ALL SELECT page_id, 'rejected' FROM pages
"""
