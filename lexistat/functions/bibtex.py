"""BibTeX fields as column expressions.

An entry is read in one pass over its quotes, braces, commas and field heads. What a mark means
depends on what is open before it, so the pass carries a state: nothing, a value in quotes, in braces or
bare, and how deep the braces inside the value are. Braces may be nested to any depth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexistat.functions.html import bound, stripped

# The fields that are read.
FIELDS = ("title", "year", "month", "day", "abstract")

QUOTED, BRACED, BARE = "quoted", "braced", "bare"

_NAME = r"[A-Za-z][A-Za-z0-9_-]*+\s*+="
# A comma with the head of a field, a mark alone, or the text between: commas that begin no field are
# text, unless they come right behind a mark.
_TOKEN = rf'(?s),\s*+{_NAME}\s*+|["{{}},]|[^"{{}},]++(?:,(?!\s*+{_NAME})[^"{{}},]*+)*+'
_OPENING = r"^[^@={}]*@\s*\w+\s*\{"

# Where the pass is: between fields, behind a head, in a value, behind a quote that may end
# its value, behind the entry.
_BETWEEN, _HEAD, _IN_QUOTES, _AT_QUOTE, _IN_BRACES, _IN_BARE, _BEHIND = range(7)
_UNSEEN = 1 << 30
_ENTRY = "array<struct<name:string,form:string,begin:int,size:int,wraps:int>>"


def _begun() -> Column:
    return F.struct(
        F.lit(0).alias("at"),
        F.lit(_BETWEEN).alias("where"),
        F.lit(0).alias("depth"),
        F.lit(_UNSEEN).alias("wraps"),
        F.lit(False).alias("seen"),
        F.lit("").alias("name"),
        F.lit(0).alias("begin"),
        F.lit(0).alias("end"),
        F.array().cast(_ENTRY).alias("found"),
    )


def _changed(state: Column, **new: Column | int) -> Column:
    names = ("at", "where", "depth", "wraps", "seen", "name", "begin", "end", "found")
    return F.struct(
        *[(F.lit(new[n]) if n in new and not isinstance(new[n], Column) else new.get(n, state[n])).alias(n)
          for n in names]
    )


def _with_value(state: Column, form: Column, end: Column) -> Column:
    """The fields found so far and the one that ends here."""
    one = F.struct(
        state["name"].alias("name"), form.alias("form"), state["begin"].alias("begin"),
        (end - state["begin"]).cast("int").alias("size"), state["wraps"].alias("wraps"),
    )
    return F.concat(state["found"], F.array(one))


def _form(where: Column) -> Column:
    return (
        F.when(where == _IN_BRACES, F.lit(BRACED)).when(where == _IN_BARE, F.lit(BARE)).otherwise(F.lit(QUOTED))
    )


def _step(state: Column, token: Column) -> Column:
    size = F.length(token)
    at, where, depth = state["at"], state["where"], state["depth"]
    next_at = (at + size).cast("int")
    is_head = token.startswith(",") & (size > 1)
    is_comma = token == ","
    opens, closes, quote = token == "{", token == "}", token == '"'
    blank = F.trim(F.translate(token, "\t\r\n", "   ")) == ""
    name = F.lower(F.regexp_extract(token, r"^,\s*([A-Za-z0-9_-]+)", 1))

    def go(**new: Column | int) -> Column:
        return _changed(state, at=next_at, **new)

    def headed(found: Column) -> Column:
        return go(where=_HEAD, depth=0, name=name, found=found)

    def value_from(begin: Column, where: int) -> Column:
        return go(where=where, depth=0, wraps=_UNSEEN, seen=False, begin=begin.cast("int"))

    # Inside a value: how many pairs of braces are around all of it, as far as it is known.
    shallower = F.least(state["wraps"], depth)
    inside = (
        F.when(opens, go(depth=depth + 1, wraps=F.when(state["seen"], shallower).otherwise(state["wraps"])))
        .when(closes, go(depth=F.greatest(depth - 1, F.lit(0)), seen=True))
        .when(blank, go())
        .otherwise(go(wraps=shallower, seen=True))
    )
    in_quotes = F.when(quote, go(where=_AT_QUOTE, end=at)).otherwise(inside)
    resumed = _changed(state, where=_IN_QUOTES, wraps=shallower, seen=True)
    ended = _with_value(state, F.lit(QUOTED), state["end"])
    level = depth == 0
    after_quote = (
        F.when(is_head, headed(ended))
        .when(level & token.rlike(r"^\s*,"), go(where=_BETWEEN, found=ended))
        .when(level & closes, go(where=_BEHIND, found=ended))
        .when(blank, go())
        # The quote was one inside the value.
        .when(quote, _changed(resumed, at=next_at, where=_AT_QUOTE, end=at))
        .when(opens, _changed(resumed, at=next_at, depth=depth + 1))
        .when(closes, _changed(resumed, at=next_at, depth=F.greatest(depth - 1, F.lit(0))))
        .otherwise(_changed(resumed, at=next_at))
    )
    in_braces = F.when(
        closes & level, go(where=_BETWEEN, depth=0, found=_with_value(state, F.lit(BRACED), at))
    ).otherwise(inside)
    bare = _with_value(state, F.lit(BARE), at)
    in_bare = (
        F.when(is_head, headed(bare))
        .when(is_comma, go(where=_BETWEEN, found=bare))
        .when(closes, go(where=_BEHIND, found=bare))
        .otherwise(go())
    )
    behind_head = (
        F.when(quote, value_from(at + 1, _IN_QUOTES))
        .when(opens, value_from(at + 1, _IN_BRACES))
        .when(is_head, headed(state["found"]))
        .when(is_comma, go(where=_BETWEEN))
        .when(closes, go(where=_BEHIND))
        .when(blank, go())
        .otherwise(value_from(at, _IN_BARE))
    )
    between = (
        F.when(is_head & level, headed(state["found"]))
        .when(opens, go(depth=depth + 1))
        .when(closes & level, go(where=_BEHIND))
        .when(closes, go(depth=depth - 1))
        .otherwise(go())
    )
    return (
        F.when(where == _IN_QUOTES, in_quotes)
        .when(where == _AT_QUOTE, after_quote)
        .when(where == _IN_BRACES, in_braces)
        .when(where == _IN_BARE, in_bare)
        .when(where == _HEAD, behind_head)
        .when(where == _BETWEEN, between)
        .otherwise(state)
    )


def _finished(state: Column) -> Column:
    """A value that nothing ends goes up to the end of the text."""
    where = state["where"]
    end = F.when(where == _AT_QUOTE, state["end"]).otherwise(state["at"])
    open_value = where.isin(_IN_QUOTES, _AT_QUOTE, _IN_BRACES, _IN_BARE)
    return F.when(open_value, _with_value(state, _form(where), end)).otherwise(state["found"])


def _unwrapped(value: Column, wraps: Column) -> Column:
    """The value without the pairs of braces that are around all of it."""
    pairs = F.when((wraps > 0) & (wraps < _UNSEEN), F.sequence(F.lit(1), wraps)).otherwise(
        F.array().cast("array<int>")
    )
    inner = F.aggregate(
        pairs, stripped(value), lambda v, _: stripped(F.substring(v, F.lit(2), F.length(v) - 2))
    )
    return F.when(wraps == _UNSEEN, F.translate(inner, "{}", "")).otherwise(inner)


def fields(bib: Column) -> Column:
    """All fields of one entry, in order, as ``array<struct<name, form, raw, value>>``.

    Names are in lower case. ``form`` says whether a value stood in quotes, in braces or bare. A quote ends
    its value where a comma, the end of the entry or the next field follows; others belong to the
    value, and so does everything in braces. ``value`` is ``raw`` without the white space and the
    braces around the whole of it, NULL if nothing is left. No comma need follow the last field,
    and the entry's own braces may be missing.
    """

    def cut(body: Column) -> Column:
        found = F.aggregate(F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(0)), _begun(), _step, _finished)

        def read(one: Column) -> Column:
            raw = F.substring(body, one["begin"] + 1, one["size"])
            value = F.nullif(_unwrapped(raw, one["wraps"]), F.lit(""))
            return F.struct(one["name"].alias("name"), one["form"].alias("form"), raw.alias("raw"), value.alias("value"))

        return F.transform(found, read)

    return bound(F.concat(F.lit(","), F.regexp_replace(bib, _OPENING, "")), cut)


def value_of(found: Column, name: str, form: str | None = None, part: str = "value") -> Column:
    """The first field of a name, of a form if one is given; NULL if there is none."""
    wanted = F.filter(
        found, lambda f: (f["name"] == name) & (F.lit(True) if form is None else f["form"] == form)
    )
    return F.nullif(F.get(wanted, F.lit(0))[part], F.lit(""))


def field(bib: Column, name: str) -> Column:
    """Value in quotes, in braces or bare."""
    return value_of(fields(bib), name)


def month(bib: Column) -> Column:
    """Month bare, in quotes or in braces."""
    return field(bib, "month")


def quoted_field(bib: Column, name: str) -> Column:
    """Value of the first ``name = "..."``, as it stands between the quotes."""
    return value_of(fields(bib), name, QUOTED, "raw")


def bare_month(bib: Column) -> Column:
    """Value of ``month = jan``, with neither quotes nor braces."""
    return value_of(fields(bib), "month", BARE)


def authors(joined: Column) -> Column:
    """Names of an `` and ``-joined author string, braces removed, without links."""
    return F.transform(
        F.split(joined, " and "),
        lambda name: F.struct(
            F.trim(F.regexp_replace(name, "[{}]", "")).alias("name"),
            F.lit(None).cast("string").alias("link"),
        ),
    )
