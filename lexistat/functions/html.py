"""Fields out of crawled HTML and of crawl rules, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


_HREF = r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
ANCHOR = rf"(?s)<a\b[^>]*?{_HREF}[^>]*>(.*?)</a>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title>"


class Mark(NamedTuple):
    """An element by its tag and classes it has among its own."""

    tag: str
    classes: tuple[str, ...]


# The marks of the portal pages that are read.
CARD_TITLE = Mark("h3", ("title",))
STEP = Mark("a", ("step",))
BADGE = Mark("span", ("concept-badge-small-container",))
PERSONS = Mark("p", ("relations", "persons"))
RENDERED = Mark("div", ("rendering_researchoutput",))
BIBTEX = Mark("pre", ("rendering_researchoutput_bibtex",))

# Elements that hold nothing and have no end.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
# Elements that end where the next of their kind begins.
SIBLINGS = ("dd", "dt", "li", "option", "p", "td", "th", "tr")

# Comments, scripts and styles whole, tags, and the text between them.
_TOKEN = (
    r"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|</?[a-z][^>]*+>"
    r"|(?:[^<]++|<(?!/?[a-z]|!--))++"
)
_STACK = "array<struct<tag:string,mark:int,begin:int>>"
_FOUND = "array<struct<begin:int,mark:int,size:int>>"

AMPERSANDS = ("amp", "AMP", "#38", "#x26")


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL where the pattern misses or matches nothing."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def all_groups(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def stripped(text: Column) -> Column:
    """Text without the white space around it, line ends and tabs included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    A plain reference would be copied by the optimizer into every lambda that uses it and then be
    computed once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _character(name: Column) -> Column:
    """Character of an entity by name, decimal or hexadecimal number; NULL if there is none."""
    listed = ",".join(f"{entity}:{point}" for entity, point in name2codepoint.items())
    point = (
        F.when(name.rlike("^#[0-9]{1,7}$"), F.substr(name, F.lit(2)))
        .when(name.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substr(name, F.lit(3)), 16, 10))
        .otherwise(F.try_element_at(F.str_to_map(F.lit(listed)), name))
    ).cast("bigint")
    known = F.when(point.between(1, 0x10FFFF), point)
    return F.decode(F.unhex(F.lpad(F.hex(known), 8, "0")), "UTF-32")


def unescape(text: Column) -> Column:
    """Text with its entities decoded, each once: what an ampersand entity leaves stays as it is."""

    def decoded(whole: Column) -> Column:
        names = F.array_distinct(all_groups(whole, "&(#?[A-Za-z0-9]+);"))
        others = F.filter(names, lambda name: ~name.isin(*AMPERSANDS))

        def put(done: Column, name: Column) -> Column:
            entity = F.concat(F.lit("&"), name, F.lit(";"))
            return F.coalesce(F.replace(done, entity, _character(name)), done)

        result = F.aggregate(others, whole, put)
        for name in AMPERSANDS:
            result = F.replace(result, F.lit(f"&{name};"), F.lit("&"))
        return result

    return bound(text, lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t))


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]*>", "")


def plain_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags removed, entities decoded."""
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>", "")
    text = F.regexp_replace(text, r"(?is)<style\b.*?</style\s*>", "")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    return unescape(without_tags(text))


def page_title(html: Column) -> Column:
    return unescape(without_tags(first_group(html, TITLE)))


def links(html: Column, pattern: str = ANCHOR) -> Column:
    """Anchors in page order as ``array<struct<name, link>>``, names trimmed.

    A target may stand in either quotes or bare: of its three groups the others are empty.
    """
    pairs = F.arrays_zip(
        all_groups(html, pattern, 4).alias("name"),
        *[all_groups(html, pattern, g).alias(f"link{g}") for g in (1, 2, 3)],
    )
    return F.transform(
        pairs,
        lambda p: F.struct(
            stripped(unescape(without_tags(p["name"]))).alias("name"),
            unescape(F.concat(p["link1"], p["link2"], p["link3"])).alias("link"),
        ),
    )


def _has(tag: Column, mark: Mark) -> Column:
    """True where an opening tag is of the mark's kind and has all its classes, in any order and quotes."""
    value = r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    listed = F.concat(*[F.regexp_extract(tag, value, group) for group in (1, 2, 3)])
    own = F.split(listed, r"\s+")
    return F.array_size(F.array_except(F.array(*map(F.lit, mark.classes)), own)) == 0


def marked(html: Column, marks: tuple[Mark, ...]) -> Column:
    """What the elements of the given marks hold, as ``array<struct<begin, mark, text>>`` in page order.

    The page is a sequence of tags and text, read once with the stack of the elements that are open. An
    end tag ends the latest open element of its kind and with it all that are open inside; one
    without such an element is ignored. So blocks may be nested to any depth and inner tags may lack their
    end. What is still open at the end of the page goes up to there. ``mark`` is a place in ``marks``.
    """
    # Tags that no mark names matter only for what they end: all are kept on the stack but the void ones.
    state = ("at", "stack", "found")

    def put(at: Column, stack: Column, found: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in zip(state, (at, stack, found), strict=True)])

    def closed(found: Column, ended: Column, end: Column) -> Column:
        kept = F.filter(ended, lambda e: e["mark"] >= 0)
        return F.concat(found, F.transform(kept, lambda e: F.struct(
            e["begin"].alias("begin"), e["mark"].alias("mark"), (end - e["begin"]).cast("int").alias("size"),
        )))

    def from_latest(stack: Column, tag: Column, body: Callable[[Column], Column], otherwise: Column) -> Column:
        """``body`` of how many elements are below the latest open one of a tag."""
        place = F.array_position(F.reverse(F.transform(stack, lambda e: e["tag"])), tag)
        return F.when(place > 0, body(F.size(stack) - place)).otherwise(otherwise)

    def step(s: Column, token: Column) -> Column:
        at, stack, found = s["at"], s["stack"], s["found"]
        end = (at + F.length(token)).cast("int")
        tag = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))
        none = F.lit(-1)
        mark = none
        for place, wanted in reversed([*enumerate(marks)]):
            mark = F.when((tag == wanted.tag) & _has(token, wanted), F.lit(place)).otherwise(mark)
        opened = F.array(F.struct(tag.alias("tag"), mark.alias("mark"), end.alias("begin")))
        top = F.get(stack, F.size(stack) - 1)
        next_of_kind = tag.isin(*SIBLINGS) & F.coalesce(top["tag"] == tag, F.lit(False))
        below = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
        opening = F.when(
            next_of_kind, put(end, F.concat(below, opened), closed(found, F.array(top), at))
        ).otherwise(put(end, F.concat(stack, opened), found))
        closing = from_latest(
            stack, tag,
            lambda n: put(
                end, F.slice(stack, F.lit(1), n.cast("int")),
                closed(found, F.slice(stack, (n + 1).cast("int"), F.size(stack)), at),
            ),
            put(end, stack, found),
        )
        is_tag = token.rlike("^</?[A-Za-z]") & ~token.rlike("(?is)^<(?:script|style)\\b")
        empty = tag.isin(*VOID) | token.endswith("/>")
        return (
            F.when(~is_tag, put(end, stack, found))
            .when(token.startswith("</"), closing)
            .when(empty, put(end, stack, found))
            .otherwise(opening)
        )

    def read(page: Column) -> Column:
        begun = put(F.lit(0), F.array().cast(_STACK), F.array().cast(_FOUND))
        found = F.aggregate(
            F.regexp_extract_all(page, F.lit(_TOKEN), F.lit(0)), begun, step,
            lambda s: F.sort_array(closed(s["found"], s["stack"], s["at"])),
        )
        return F.transform(found, lambda f: F.struct(
            f["begin"].alias("begin"), f["mark"].alias("mark"),
            F.substring(page, f["begin"] + 1, f["size"]).alias("text"),
        ))

    return bound(html, read)


def inner(found: Column, mark: int) -> Column:
    """What all elements of one mark hold, in page order."""
    return F.transform(F.filter(found, lambda f: f["mark"] == mark), lambda f: f["text"])


def elements(html: Column, mark: Mark) -> Column:
    return inner(marked(html, (mark,)), 0)


def first_element(html: Column, mark: Mark) -> Column:
    """What the first element of a mark holds; NULL if there is none or it is empty."""
    return F.nullif(F.get(elements(html, mark), F.lit(0)), F.lit(""))


def last_page(html: Column, default: int = 0) -> Column:
    """Number on the last pagination step, ``default`` where there is none or no number."""
    last = F.try_element_at(elements(html, STEP), F.lit(-1))
    return F.coalesce(stripped(without_tags(last)).try_cast("int"), F.lit(default))


def page_urls(base: Column, last: Column) -> Column:
    """Listing URLs ``base?page=0 .. last-1``; one page where ``last`` is 0."""
    numbers = F.sequence(F.lit(0), F.greatest(last, F.lit(1)) - 1)
    return F.transform(numbers, lambda i: F.concat(base, F.lit("?page="), i.cast("string")))


def authors_from_text(names: Column, anchors: Column) -> Column:
    """Comma-separated names; each takes the link of the first anchor of the same text."""

    def linked(people: Column) -> Column:
        def one(part: Column) -> Column:
            same = F.filter(people, lambda a: a["name"] == stripped(part))
            return F.struct(
                stripped(part).alias("name"), F.get(same, F.lit(0))["link"].alias("link")
            )

        return F.transform(F.split(names, ","), one)

    return bound(anchors, linked)


def detail_and_output(rendered: Column) -> Column:
    """Second and third line of a rendered result as ``struct<detail, output>``."""
    lines = F.split(rendered, "\n")
    return F.struct(
        F.get(lines, F.lit(1)).alias("detail"), F.get(lines, F.lit(2)).alias("output")
    )


def rule_pattern(rule: str) -> str:
    """Regular expression of one crawl rule: ``*`` is any run, the rest is literal."""
    return ".*".join(re.escape(part) for part in rule.split("*"))


def robots_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\r\n|\r|\n"), stripped)


def robots_directives(text: Column) -> Column:
    """``struct<crawl_delay, sitemap, rules>`` of one robots text.

    Keys in any case; the last delay and the first sitemap count; delay 5 where none is given;
    an empty rule is no rule.
    """

    def read(lines: Column) -> Column:
        def values(key: str) -> Column:
            hits = F.filter(lines, lambda line: F.lower(line).startswith(f"{key}:"))
            return F.transform(hits, lambda line: stripped(F.substr(line, F.lit(len(key) + 2))))

        delay = F.try_element_at(values("crawl-delay"), F.lit(-1)).try_cast("int")
        return F.struct(
            F.coalesce(delay, F.lit(5)).alias("crawl_delay"),
            F.get(values("sitemap"), F.lit(0)).alias("sitemap"),
            F.filter(values("disallow"), lambda rule: rule != "").alias("rules"),
        )

    return bound(robots_lines(text), read)
