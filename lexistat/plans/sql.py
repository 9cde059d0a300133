"""SQL fragments shared by the checks."""

from __future__ import annotations

from lexistat.functions.text import SPLIT_WORDS, STOP_WORDS

STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)


def clean_tokens(text: str) -> str:
    """Cleaned tokens of a text expression as a list, stop words removed."""
    spaced = f"replace(regexp_replace(lower({text}), '[^a-z0-9#+]', ' ', 'g'), '#', ' # ')"
    for word in SPLIT_WORDS:
        joined = word.replace(" ", "")
        if joined == "wanna":
            spaced = f"regexp_replace({spaced}, '\\bwanna( |$)', 'wan na\\1', 'g')"
        else:
            spaced = f"regexp_replace({spaced}, '\\b{joined}\\b', '{word}', 'g')"
    return (
        f"list_filter(string_split_regex({spaced}, ' +'), "
        f"lambda t: t <> '' AND t NOT IN ({STOP_LIST}))"
    )


# Corpus weights: idx (index tokens), vec (vectoriser terms), idf, w (unit-length weights).
INDEX = f"""
cl AS (SELECT doc_id, {clean_tokens('text')} AS words FROM documents),
idx AS (SELECT doc_id, term, count(*) AS n
        FROM (SELECT doc_id, unnest(words) AS term FROM cl) GROUP BY ALL),
vec AS (SELECT doc_id, term, count(*) AS tf
        FROM (SELECT doc_id,
                     unnest(regexp_extract_all(array_to_string(words, ' '), '[a-z0-9]{{2,}}')) AS term
              FROM cl) GROUP BY ALL),
size AS (SELECT count(*) AS n FROM documents),
idf AS (SELECT term, count(*) AS df, ln((1.0 + (SELECT n FROM size)) / (1.0 + count(*))) + 1 AS idf
        FROM vec GROUP BY term),
raw AS (SELECT doc_id, term, tf, tf * idf AS x FROM vec JOIN idf USING (term)),
len AS (SELECT doc_id, sqrt(sum(x * x)) AS l FROM raw GROUP BY doc_id),
w AS (SELECT doc_id, term, tf, x / l AS w FROM raw JOIN len USING (doc_id))
"""


def queries(table: str) -> str:
    """Query tokens and weights for a table expression (query_id, query); after INDEX."""
    return f"""
q AS ({table}),
qcl AS (SELECT query_id, {clean_tokens('query')} AS words FROM q),
qidx AS (SELECT DISTINCT query_id, unnest(words) AS term FROM qcl),
qvec AS (SELECT query_id, term, count(*) AS tf
         FROM (SELECT query_id,
                      unnest(regexp_extract_all(array_to_string(words, ' '), '[a-z0-9]{{2,}}')) AS term
               FROM qcl) GROUP BY ALL),
qraw AS (SELECT query_id, term, tf * idf AS x FROM qvec JOIN idf USING (term)),
qlen AS (SELECT query_id, sqrt(sum(x * x)) AS l FROM qraw GROUP BY query_id),
qw AS (SELECT query_id, term, x / l AS w FROM qraw JOIN qlen USING (query_id)),
cand AS (SELECT DISTINCT query_id, doc_id FROM qidx JOIN idx USING (term)),
prod AS (SELECT query_id, doc_id, sum(qw.w * w.w) AS s FROM qw JOIN w USING (term) GROUP BY ALL),
sc AS (SELECT query_id, doc_id, coalesce(s, 0.0) AS score
       FROM cand LEFT JOIN prod USING (query_id, doc_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
       FROM sc)
"""


def unescape(text: str) -> str:
    for entity, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
        ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
    ):
        text = f"replace({text}, '{entity}', '{character}')"
    return text


def plain_text(html: str) -> str:
    for pattern in ("(?s)<script.*?</script>", "(?s)<style.*?</style>", "(?s)<!--.*?-->", "<[^>]*>"):
        html = f"regexp_replace({html}, '{pattern}', '', 'g')"
    return unescape(html)


def links(html: str, pattern: str = '<a href="([^"]*)"[^>]*>([^<]*)</a>') -> str:
    """List of (name, link) structs of the anchors."""
    names = f"regexp_extract_all({html}, '{pattern}', 2)"
    hrefs = f"regexp_extract_all({html}, '{pattern}', 1)"
    return (
        f"list_transform(list_zip({names}, {hrefs}), "
        f"lambda p: {{'name': trim({unescape('p[1]')}), 'link': p[2]}})"
    )


def field(name: str, value: str) -> str:
    return f"'  {name} = ' || op || {value} || cl"


# Landed pages as entries of a publication portal: portal(page_id, url, html), and base with the
# parts each entry is made of.
PORTAL = f"""
base0 AS (
  SELECT page_id, url, {unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
         {links('html')} AS anchors, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
         {plain_text('html')} AS text,
         coalesce(try_cast(regexp_extract(url, '/[a-z][a-z]/([0-9]+)', 1) AS INT), 0) AS number,
         regexp_extract(url, '^https?://([^/]+)', 1) AS host
  FROM pages),
base AS (
  SELECT *, list_transform(anchors, lambda a: a.name) AS names,
         CASE WHEN lang <> 'de' THEN (number % 28 + 1)::VARCHAR END AS day,
         ['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'][number % 12 + 1] AS month,
         (number % 26 + 2000)::VARCHAR AS year,
         CASE WHEN lang IN ('fr', 'es') THEN '{{' ELSE '"' END AS op,
         CASE WHEN lang IN ('fr', 'es') THEN '}},' || chr(10) ELSE '",' || chr(10) END AS cl,
         replace(replace(replace(title, '&', '{{\\&}}'), '%', '\\%'), '$', '\\$') AS latex
  FROM base0),
base2 AS (
  SELECT *,
         '@article{{p' || page_id || ',' || chr(10) || {field('title', 'latex')}
         || {field('author', "array_to_string(names, ' and ')")} || {field('year', 'year')}
         || '  month = ' || month || ',' || chr(10) || coalesce({field('day', 'day')}, '')
         || {field('abstract', 'text')} || '}}' AS bib,
         array_to_string(names, ', ') || ', '
         || trim(coalesce(day, '') || ' ' || upper(month[1]) || month[2:] || ' ' || year)
         || ', In: ' || host || CASE WHEN lang <> 'en' THEN '. ' || number ELSE '' END AS detail
  FROM base),
portal AS (
  SELECT page_id, url,
    '<div class="result-container"><h3 class="title"><a href="' || url || '">' || title
    || '</a></h3><p class="relations persons">'
    || array_to_string(list_transform(anchors,
         lambda a: '<a href="' || a.link || '">' || a.name || '</a>'), ', ')
    || ', ' || lang || ' Group</p><div class="rendering_researchoutput">' || title || chr(10) || detail
    || chr(10) || 'Research output: ' || lang || '</div>'
    || array_to_string(list_transform(names, lambda n, i:
         '<span class="concept-badge-small-container">' || n || chr(10) || (110 - 10 * i) || '%</span>'), '')
    || '<pre class="rendering_researchoutput_bibtex">' || bib || '</pre></div><nav class="pages">'
    || CASE WHEN number % 9 > 0 THEN array_to_string(list_transform(range(1, number % 9 + 2),
         lambda i: '<a class="step">' || i || '</a>'), '') ELSE '' END || '</nav>' AS html
  FROM base2)
"""


def bib_field(name: str, bib: str = "bib") -> str:
    """A quoted value ends at a quote before a comma, one in braces at a brace before a comma and a line end."""
    pattern = f'(?s),\\s*{name}\\s*=\\s*(?:"(.*?)"\\s*,|\\{{(.*?)\\}},\n)'
    found = f"regexp_extract({bib}, '{pattern}', 1) || regexp_extract({bib}, '{pattern}', 2)"
    return f"nullif(regexp_replace({found}, '^\\s+|\\s+$', '', 'g'), '')"


# Parsed entries: pub(id, title, authors, author, year, month, day, abstract, detail, output, link,
# concepts).
PUBLICATIONS = f"""{PORTAL},
cut AS (
  SELECT page_id, {unescape("regexp_extract(html, '(?s)<pre class=\"rendering_researchoutput_bibtex\">(.*?)</pre>', 1)")} AS bib,
         regexp_extract(html, '(?s)<p class="relations persons">(.*?)</p>', 1) AS persons,
         string_split({plain_text("regexp_extract(html, '(?s)<div class=\"rendering_researchoutput\">(.*?)</div>', 1)")}, chr(10)) AS lines,
         regexp_extract(html, '<h3 class="title"><a href="([^"]*)"', 1) AS link,
         list_transform(regexp_extract_all(html,
           '<span class="concept-badge-small-container">([^<]*)</span>', 1), lambda c: {unescape('c')}) AS concepts
  FROM portal),
pub AS (
  SELECT page_id AS id, {bib_field('title')} AS title,
         list_transform(string_split({plain_text('persons')}, ','), lambda n: {{'name': trim(n),
           'link': list_filter({links('persons')}, lambda a: a.name = trim(n))[1].link}}) AS authors,
         {bib_field('author')} AS author, {bib_field('year')} AS year,
         regexp_extract(bib, '\\bmonth\\s*=\\s*([A-Za-z0-9]+)\\s*,', 1) AS month,
         {bib_field('day')} AS day, {bib_field('abstract')} AS abstract,
         lines[2] AS detail, lines[3] AS output, link, concepts
  FROM cut)
"""
