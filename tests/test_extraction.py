import pytest
from pyspark.sql import functions as F

from lexistat.functions import bibtex, html, shaping
from lexistat.operators import records, urls


def one(spark, value, expression, kind="string"):
    row = spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("x")).first()
    return row["x"]


QUOTED = '''@article{k, booktitle = "Not this", title = "A {B} title",
 author = "A. One and Two, {B.}", year = "2024",
 month = jan,
 day = "3",
 abstract = "line one
line two",
}'''
BRACED = "@article{k, title = {{A} braced}, year = {2023}, month = {feb}, abstract = {x y},}"


@pytest.mark.parametrize(
    "bib, name, wanted",
    [
        (QUOTED, "title", "A {B} title"),
        (QUOTED, "year", "2024"),
        (QUOTED, "day", "3"),
        (QUOTED, "abstract", "line one\nline two"),
        (BRACED, "title", "{A} braced"),
        (BRACED, "year", "2023"),
        (BRACED, "day", None),
    ],
)
def test_bibtex_field(spark, bib, name, wanted):
    assert one(spark, bib, lambda c: bibtex.field(c, name)) == wanted


def test_bibtex_month_in_every_form(spark):
    assert one(spark, QUOTED, bibtex.month) == "jan"
    assert one(spark, BRACED, bibtex.month) == "feb"
    assert one(spark, QUOTED, bibtex.bare_month) == "jan"
    assert one(spark, "no fields", bibtex.month) is None


def test_quoted_field_does_not_take_a_longer_name(spark):
    assert one(spark, QUOTED, lambda c: bibtex.quoted_field(c, "title")) == "A {B} title"


DEEP = "{a {b {c {d {e {f} g} h} i} j} k}"


SCANNED = [
    # A quote inside a value, followed by no comma.
    ('@a{k, abstract = "he said "yes" and left",\n year = "2020"}', "abstract", 'he said "yes" and left'),
    ('@a{k, abstract = "he said "yes" and left",\n year = "2020"}', "year", "2020"),
    # A field head inside another value, in quotes and in braces.
    ('@a{k, abstract = "see title = "Wrong" there",\n title = {Right}}', "title", "Right"),
    ('@a{k, abstract = {see, title = "Wrong", year = {1}}, title = "Right"}', "title", "Right"),
    ('@a{k, title = {Right}, abstract = "title = "Wrong""}', "title", "Right"),
    # Any depth.
    (f"@a{{k, title = {{x {DEEP} y}}, year = 2001}}", "title", f"x {DEEP} y"),
    (f'@a{{k, title = "x {DEEP} y", year = 2001}}', "title", f"x {DEEP} y"),
    (f"@a{{k, title = {DEEP}, year = 2001}}", "year", "2001"),
    # The last field needs no comma, the entry no braces of its own.
    ('@a{k, year = "1999", title = "Last"}', "title", "Last"),
    ('@a{k, year = "1999", title = {Last}\n}', "title", "Last"),
    ("@a{k, year = 1999, month = jan}", "month", "jan"),
    ('title = "Bare", year = 7', "title", "Bare"),
    ('title = "Bare", year = 7', "year", "7"),
    # Quotes in braces and braces in quotes, with commas behind them.
    ('@a{k, title = {A "b", c}, year = 1}', "title", 'A "b", c'),
    ('@a{k, title = "A {b}, c", year = 1}', "title", "A {b}, c"),
    ('@a{k, title = "A {"b",} c", year = 1}', "title", 'A {"b",} c'),
    # Braces around the whole go, those around parts stay.
    ("@a{k, title = {{{Whole}}}}", "title", "Whole"),
    ('@a{k, title = "{Whole}"}', "title", "Whole"),
    ("@a{k, title = {{A} and {B}}}", "title", "{A} and {B}"),
    ("@a{k, title = { {A} }}", "title", "A"),
    # Names in any case, longer names, missing and empty values.
    ('@A{k, Title = "Any", BookTitle = "No"}', "title", "Any"),
    ('@a{k, booktitle = "No"}', "title", None),
    ('@a{k, title = {}, year = ""}', "title", None),
    ('@a{k, title = , year = "2"}', "year", "2"),
    ('@a{k, title = "first", title = "second"}', "title", "first"),
    # What is never ended goes up to the end.
    ('@a{k, title = "open', "title", "open"),
    ("no entry at all", "title", None),
    ("", "title", None),
    (None, "title", None),
]


def test_bibtex_scan(spark):
    rows = spark.createDataFrame([(i, bib) for i, (bib, _, _) in enumerate(SCANNED)], "i int, bib string")
    found = rows.select("i", *[bibtex.field(F.col("bib"), name).alias(name) for name in ("title", "year", "month", "abstract")])
    for row in found.collect():
        bib, name, wanted = SCANNED[row["i"]]
        assert row[name] == wanted, bib


def test_bibtex_long_values(spark):
    """A value of many commas, quotes and braces is read without deep recursion."""
    body = 'word, {x} "y" z ' * 20_000
    entry = f"@a{{k, abstract = {{{body}}}, year = 2020}}"
    found = spark.createDataFrame([(entry,)], "v string").select(bibtex.fields(F.col("v")).alias("f")).first()["f"]
    assert [(f["name"], f["form"]) for f in found] == [("abstract", "braced"), ("year", "bare")]
    assert found[0]["raw"] == body and found[0]["value"] == body.strip()


def test_views_of_the_scan_tell_forms_apart(spark):
    assert one(spark, BRACED, lambda c: bibtex.quoted_field(c, "title")) is None
    assert one(spark, BRACED, bibtex.bare_month) is None
    assert one(spark, '@a{k, title = " {x} "}', lambda c: bibtex.quoted_field(c, "title")) == " {x} "


def nested(depth, tag="div", text="core"):
    return f"<{tag}>" * depth + text + f"</{tag}>" * depth


MARKED = [
    (f'<div class="rendering_researchoutput">a{nested(6)}b</div>c', [f"a{nested(6)}b"]),
    ('<div class="x rendering_researchoutput"><p>a<b>c</div>after</div>', ["<p>a<b>c"]),
    ("<section><div class='rendering_researchoutput'>a<span>b</section>c", ["a<span>b"]),
    ('<div class="rendering_researchoutput">a<br>b<img src="x">c</div>', ['a<br>b<img src="x">c']),
    ('<div class="rendering_researchoutput">a</span>b</div>', ["a</span>b"]),
    ('<div class="rendering_researchoutput">a <!-- </div> --> b</div>', ["a <!-- </div> --> b"]),
    ('<div class="rendering_researchoutput">a<script>"</div>"</script>b</div>', ['a<script>"</div>"</script>b']),
    ('<div class="rendering_researchoutput">open', ["open"]),
    ('<DIV CLASS=rendering_researchoutput>1 < 2</DIV>', ["1 < 2"]),
    ('<div class="rendering_researchoutput_bibtex">no</div>', []),
    (f'<div class="rendering_researchoutput">a<div class="rendering_researchoutput">b</div></div>',
     ['a<div class="rendering_researchoutput">b</div>', "b"]),
    ("", []),
]


def test_elements_by_the_stack_of_tags(spark):
    rows = spark.createDataFrame([(i, page) for i, (page, _) in enumerate(MARKED)], "i int, page string")
    for row in rows.select("i", html.elements(F.col("page"), html.RENDERED).alias("found")).collect():
        page, wanted = MARKED[row["i"]]
        assert row["found"] == wanted, page


def test_paragraphs_end_where_the_next_begins(spark):
    page = '<p class="relations persons"><a href="/1">Ann</a><p>other</p>'
    assert one(spark, page, lambda c: html.first_element(c, html.PERSONS)) == '<a href="/1">Ann</a>'


def test_all_marks_in_one_pass(spark):
    page = (
        '<h3 class="title"><a href="/x">T</a></h3>' + nested(6, "div", '<span class="concept-badge-small-container">'
        "One<span><span>\n9%</span></span></span>") + '<p class="persons relations">A, B</p>'
    )
    marks = (html.PERSONS, html.CARD_TITLE, html.BADGE)
    found = one(spark, page, lambda c: html.marked(c, marks))
    assert [(f["mark"], f["text"]) for f in found] == [
        (1, '<a href="/x">T</a>'), (2, "One<span><span>\n9%</span></span>"), (0, "A, B"),
    ]


def test_bibtex_authors(spark):
    people = one(spark, "Ann Bee and Cee, {D. E.}", bibtex.authors)
    assert [(p["name"], p["link"]) for p in people] == [("Ann Bee", None), ("Cee, D. E.", None)]


def test_author_takes_the_first_anchor_of_its_name(spark):
    page = '<a href="/1">Ann</a>, Outsider, <a href="/2">Bob</a>, <a href="/3">Ann</a>'
    people = one(
        spark, page, lambda c: html.authors_from_text(html.plain_text(c), html.links(c))
    )
    assert [(p["name"], p["link"]) for p in people] == [
        ("Ann", "/1"), ("Outsider", None), ("Bob", "/2"), ("Ann", "/1"),
    ]


def test_plain_text_drops_code_and_decodes(spark):
    page = '<style>p{}</style><p>a &amp;lt; b<!-- no --></p><script>var t="</p>";</script>&copy;'
    assert one(spark, page, html.plain_text) == "a &lt; b©"


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("no entity", "no entity"),
        ("a &lt;b&gt; &eacute;&#233;&#xE9;&#x1F600;", "a <b> \u00e9\u00e9\u00e9\U0001f600"),
        ("&amp;lt; &#38;lt; &amp;#39; &AMP;amp;", "&lt; &lt; &#39; &amp;"),
        ("&nosuch; & &#xFFFFFFFF; &#; fish&chips;", "&nosuch; & &#xFFFFFFFF; &#; fish&chips;"),
        (None, None),
    ],
)
def test_entities_are_decoded_once(spark, text, wanted):
    assert one(spark, text, html.unescape) == wanted


def test_result_cards_with_attributes_and_inner_tags(spark):
    page = (
        '<h3 class="title"><a rel="x" href="/p?a=1&amp;b=2" class="link"><span>A &amp; B</span></a></h3>'
        '<h3 class="other"><a href="/no">No</a></h3>'
        '<h3 class="title">\n<a href="/q">C</a></h3>'
    )
    cards = records.result_cards(spark.createDataFrame([(1, page)], "id int, html string"), ["id"])
    assert [(r["place"], r["name"], r["link"]) for r in cards.collect()] == [
        (0, "A & B", "/p?a=1&b=2"), (1, "C", "/q"),
    ]


@pytest.mark.parametrize("steps, wanted", [("", 0), ("1 2 7", 7), ("1 next", 0)])
def test_last_page(spark, steps, wanted):
    page = "".join(f'<a class="step">{s}</a>' for s in steps.split())
    assert one(spark, page, html.last_page) == wanted


def test_page_urls(spark):
    found = one(spark, 3, lambda c: html.page_urls(F.lit("u"), c), "int")
    assert found == ["u?page=0", "u?page=1", "u?page=2"]
    assert one(spark, 0, lambda c: html.page_urls(F.lit("u"), c), "int") == ["u?page=0"]


def test_detail_and_output_may_be_missing(spark):
    assert tuple(one(spark, "t\nd\no", html.detail_and_output)) == ("d", "o")
    assert tuple(one(spark, "t", html.detail_and_output)) == (None, None)


ROBOTS = """User-agent: *
DISALLOW: /*?*format=rss
disallow:
Disallow: /private
Crawl-Delay: 3
crawl-delay: 9
Sitemap: https://s.example/a.xml
SITEMAP: https://s.example/b.xml"""


def test_robots_directives(spark):
    d = one(spark, ROBOTS, html.robots_directives)
    assert (d["crawl_delay"], d["sitemap"]) == (9, "https://s.example/a.xml")
    assert d["rules"] == ["/*?*format=rss", "/private"]
    empty = one(spark, "nothing", html.robots_directives)
    assert tuple(empty) == (5, None, [])


def test_rules_block_urls(spark):
    rows = [("https://h/x?format=rss",), ("https://h/x?a=1&format=rss",), ("https://h/private/1",),
            ("https://h/x",), ("https://h/format=rss",)]
    found = urls.allowed(spark.createDataFrame(rows, "url string"), ["/*?*format=rss", "", "/private"])
    assert [r["url"] for r in found.collect()] == ["https://h/x", "https://h/format=rss"]
    everything = urls.allowed(spark.createDataFrame(rows, "url string"), [])
    assert everything.count() == len(rows)


def test_url_lists(spark):
    rows = [(1, 0, "https://h/a.xml"), (1, 1, "https://h/organisations.xml"), (2, 0, "https://h/a.xml"),
            (2, 1, "https://h/organisations.xml"), (2, 2, "https://h/organisations/x")]
    listed = spark.createDataFrame(rows, "page int, place int, url string")
    first = urls.first_match(listed, "organisations", "organisations.xml", ["page", "place"])
    assert first.collect()[0].asDict() == {"page": 1, "place": 1, "url": "https://h/organisations.xml"}
    assert urls.first_match(listed, "nowhere", ".xml", ["page", "place"]).collect() == []
    seen = {r["url"]: (r["page"], r["place"]) for r in urls.first_seen(listed, ["page", "place"]).collect()}
    assert seen["https://h/a.xml"] == (1, 0) and len(seen) == 3
    assert urls.entries(listed, "/organisations", "x").count() == 1
    assert urls.with_suffix(listed, "/publications", ["*.xml/"]).count() == 1


def test_latex_title(spark):
    title = r"{On} {\textquoteright}A{ \textquoteleft }  {\&} 5\% of \$9 {\textquotedblright}{B}} "
    assert one(spark, title, shaping.latex_title) == "On 'A' & 5% of $9 \"B"
    assert one(spark, None, shaping.latex_title) is None


def test_date_and_journal(spark):
    rows = [("A, B, 2 Jan 2025, In: J. 1", "2", "jan", "2025"), ("A, Jul 2025, In: K", None, "jul", "2025"),
            ("no date", "1", "may", "2000"), ("x 1 May 2000, y 1 May 2000, z", "1", "may", "2000"),
            (None, None, None, None)]
    df = spark.createDataFrame(rows, "detail string, day string, month string, year string")
    date = shaping.date_text(F.col("day"), F.col("month"), F.col("year"))
    found = df.withColumn("date", date).select(
        "date", shaping.journal(F.col("detail"), F.col("date")).alias("journal")
    ).collect()
    assert [r["date"] for r in found] == ["2 Jan 2025", " Jul 2025", "1 May 2000", "1 May 2000", "  "]
    assert [r["journal"] for r in found] == [
        " In: J. 1", " In: K", "no date", "x 1 May 2000, y 1 May 2000, z", "Unknown Journal",
    ]


def test_concepts(spark):
    tags = one(spark, ["Bank Loans\n87%", "Bare"], shaping.concept_tags, "array<string>")
    assert [tuple(t) for t in tags] == [("Bank Loans", 87), ("Bare", None)]


def test_author_list_rules(spark):
    kind = "array<struct<name:string,link:string>>"
    people = [("Ann", "/1"), ("Bob", "/2"), ("Cy", None)]
    rewritten = one(spark, people, lambda c: shaping.listed_links_only(c, ["Ann"]), kind)
    assert [tuple(p) for p in rewritten] == [("Ann", "/1"), ("Bob", ""), ("Cy", "")]
    assert one(spark, people, shaping.author_line, kind) == (
        '<a target="_blank" href="/1">Ann</a>, <a target="_blank" href="/2">Bob</a>, Cy'
    )
    text = one(spark, people, lambda c: shaping.search_text(F.lit("T"), c, ["Ann", "Cy"]), kind)
    assert text == "T Ann Cy"


def test_defaults(spark):
    assert one(spark, "", shaping.link_or_hash) == "#"
    assert one(spark, None, shaping.list_or_empty, "array<string>") == []


def test_records_without_details_are_rejected(spark):
    rows = [(1, "<p>nothing</p>"), (2, '<pre class="rendering_researchoutput_bibtex">year = "2001",</pre>')]
    read = records.parse_publications(spark.createDataFrame(rows, "id bigint, html string"), "id")
    accepted, rejected = records.accepted_and_rejected(read)
    assert [r["id"] for r in accepted.collect()] == [2]
    assert [r["id"] for r in rejected.collect()] == [1]


def test_older_author_string_fills_the_list(spark):
    df = spark.createDataFrame([("A and B", None)], "author string, authors array<struct<name:string,link:string>>")
    assert [a["name"] for a in records.with_author_list(df).first()["authors"]] == ["A", "B"]


def test_bibtex_values_keep_their_braces_and_need_no_comma(spark):
    bib = '@a{k, title = "On the {UK}, and more",\n abstract = {\n two {n{es}ted} lines\n}, year = "2024"\n}'
    assert one(spark, bib, lambda c: bibtex.field(c, "title")) == "On the {UK}, and more"
    assert one(spark, bib, lambda c: bibtex.field(c, "abstract")) == "two {n{es}ted} lines"
    assert one(spark, bib, lambda c: bibtex.field(c, "year")) == "2024"
    assert one(spark, "x = {{Whole Title}}", lambda c: bibtex.field(c, "x")) == "Whole Title"


def test_marks_among_other_classes_and_any_quotes(spark):
    page = (
        "<h3 class='big title x'><a class=c href='/p'>T</a></h3>"
        '<p class="persons wide relations"><a href=/ann>Ann</a>,\nBob</p>'
        '<div id=1 class="rendering_researchoutput more">T\n<div>d</div>etail\nout</div>'
        '<span class="x concept-badge-small-container">C<span>1</span>\n80%</span>'
        '<h3 class="subtitle"><a href="/no">N</a></h3><a class="next step">7</a>'
    )
    rows = spark.createDataFrame([(1, page)], "page_id long, html string")
    got = records.parse_publications(rows, "page_id").first()
    assert got["link"] == "/p" and (got["detail"], got["output"]) == ("detail", "out")
    assert [(a["name"], a["link"]) for a in got["authors"]] == [("Ann", "/ann"), ("Bob", None)]
    assert got["concepts"] == ["C1\n80%"]
    cards = records.result_cards(rows, ["page_id"]).collect()
    assert [(c["name"], c["link"]) for c in cards] == [("T", "/p")]
    assert one(spark, page, html.last_page) == 7


def test_robots_lines_with_tabs_and_other_line_ends(spark):
    text = "Disallow:\t/private\r\tdisallow: /x \nCrawl-delay:\t3"
    got = one(spark, text, html.robots_directives)
    assert got["rules"] == ["/private", "/x"] and got["crawl_delay"] == 3


def test_rows_without_url_and_rules_of_other_sites_do_not_block(spark):
    rows = [(None,), ("https://a/private/1",), ("https://b/private/1",)]
    found = spark.createDataFrame(rows, "url string")
    assert {r["url"] for r in urls.allowed(found, ["/private"]).collect()} == {None}
    rules = spark.createDataFrame([("https://a", "/private*"), ("https://b", " ")], "site string, rule string")
    assert {r["url"] for r in urls.allowed_by_site(found, rules).collect()} == {None, "https://b/private/1"}


def test_search_text_without_title_or_authors(spark):
    kind = "array<struct<name:string,link:string>>"
    assert one(spark, None, lambda c: shaping.search_text(F.lit("T"), c, ["Ann"]), kind) == "T "
    assert one(spark, [("Ann", None)], lambda c: shaping.search_text(F.lit(None), c, ["Ann"]), kind) == " Ann"


def test_latex_marks_alone_and_in_braces(spark):
    title = "\\textquotedblleft{}A{ \\textquoteright }s\\_b\\# {\\textquotedblright}"
    assert one(spark, title, shaping.latex_title) == "\"A's_b# \""
