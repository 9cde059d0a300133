"""Search results as they are shown: titles, dates, journals, author lines, tags."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# LaTeX marks that titles hold and the characters they stand for.
LATEX_MARKS = {
    r"\textquoteleft": "'",
    r"\textquoteright": "'",
    r"\textquotedblleft": '"',
    r"\textquotedblright": '"',
    r"\&": "&",
    r"\$": "$",
    r"\%": "%",
    r"\_": "_",
    r"\#": "#",
}


def latex_title(title: Column) -> Column:
    """Title without LaTeX: marks, alone or in braces of their own, become characters; braces go.

    The title is cut at its marks in one pass and joined again with what they stand for.
    """
    # Longer marks first, so that none hides behind its beginning.
    marks = "|".join(re.escape(m) for m in sorted(LATEX_MARKS, key=len, reverse=True))
    found = rf"\{{\s*(?:{marks})\s*\}}|(?:{marks})"
    table = F.create_map(*[F.lit(part) for pair in LATEX_MARKS.items() for part in pair])
    names = F.transform(
        F.regexp_extract_all(title, F.lit(found), F.lit(0)),
        lambda m: F.try_element_at(table, F.regexp_replace(m, r"[{}\s]", "")),
    )
    between = F.transform(F.split(title, found), lambda text: F.regexp_replace(text, "[{}]", ""))
    joined = F.array_join(
        F.transform(F.arrays_zip(between.alias("text"), names.alias("mark")),
                    lambda x: F.concat(x["text"], F.coalesce(x["mark"], F.lit("")))), ""
    )
    return F.trim(F.regexp_replace(joined, r"\s+", " "))


def capitalise(text: Column) -> Column:
    """First letter in upper case, the rest as it is; NULL gives an empty string."""
    return F.coalesce(
        F.concat(F.upper(F.left(text, F.lit(1))), F.substr(text, F.lit(2))), F.lit("")
    )


def date_text(day: Column, month: Column, year: Column) -> Column:
    """``d Mon yyyy`` with nothing in the place of a missing part."""
    blank = F.lit("")
    return F.concat_ws(
        " ", F.coalesce(day, blank), capitalise(month), F.coalesce(year, blank)
    )


def journal(detail: Column, date: Column) -> Column:
    """What follows ``<date>,`` in the citation line if that occurs exactly once."""
    mark = F.concat(date, F.lit(","))
    removed = F.length(detail) - F.length(F.replace(detail, mark, F.lit("")))
    after = F.call_function("substring_index", detail, mark, F.lit(-1))
    text = F.when(removed == F.length(mark), after).otherwise(detail)
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("Unknown Journal"))


def author_line(authors: Column) -> Column:
    """Names joined by commas, as links where a link is known."""
    return F.array_join(
        F.transform(
            authors,
            lambda a: F.when(
                F.coalesce(a["link"], F.lit("")) != "",
                F.concat(
                    F.lit('<a target="_blank" href="'), a["link"], F.lit('">'), a["name"],
                    F.lit("</a>"),
                ),
            ).otherwise(a["name"]),
        ),
        ", ",
    )


def concept_tags(concepts: Column) -> Column:
    """``"<name>\\n<NN>%"`` as ``struct<name, pct>``; no second line gives NULL."""

    def tag(concept: Column) -> Column:
        lines = F.split(concept, "\n")
        pct = F.replace(F.get(lines, F.lit(1)), F.lit("%"), F.lit(""))
        return F.struct(
            F.get(lines, F.lit(0)).alias("name"), pct.try_cast("int").alias("pct")
        )

    return F.transform(concepts, tag)


def link_or_hash(link: Column) -> Column:
    return F.coalesce(F.nullif(link, F.lit("")), F.lit("#"))


def list_or_empty(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))


def any_field_contains(query: str, *, title: Column, authors: Column, journal: Column,
                       tags: Column) -> Column:
    """True where title, author line, journal or a tag name holds the query, in any case."""
    wanted = query.lower()
    return (
        F.lower(title).contains(wanted)
        | F.lower(authors).contains(wanted)
        | F.lower(journal).contains(wanted)
        | F.exists(tags, lambda t: F.lower(t["name"]).contains(wanted))
    )


def listed_links_only(authors: Column, names: list[str]) -> Column:
    """Authors outside the list keep their name and lose their link."""
    return F.transform(
        authors,
        lambda a: F.struct(
            F.coalesce(a["name"], F.lit("")).alias("name"),
            F.when(a["name"].isin(names), a["link"]).otherwise(F.lit("")).alias("link"),
        ),
    )


def search_text(title: Column, authors: Column, names: list[str]) -> Column:
    """Title followed by the listed authors' names; what is missing is left blank."""
    listed = F.transform(F.filter(authors, lambda a: a["name"].isin(names)), lambda a: a["name"])
    names_of = F.coalesce(F.array_join(listed, " "), F.lit(""))
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), names_of)
