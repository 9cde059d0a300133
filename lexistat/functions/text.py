"""Text cleaning and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public English stop list, without the forms that hold an apostrophe
# (cleaning turns an apostrophe into a space before the list is looked up).
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now d ll m o re
    ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn
    weren won wouldn
    """.split()
)

# Words the tokeniser splits in two, at the point marked by the blank.
SPLIT_WORDS = ("can not", "gim me", "gon na", "got ta", "lem me", "wan na")

# Endings that inflected English words lose, and what takes their place, as the public
# lexical database lists them: nouns, verbs, adjectives.
SUFFIX_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
    ("men", "man"), ("ies", "y"),
    ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
    ("er", ""), ("est", ""), ("er", "e"), ("est", "e"),
)

_SPLIT_PATTERN = r"\b(?:" + "|".join(
    f"({head})(?={tail}{'(?: |$)' if head == 'wan' else chr(92) + 'b'})"
    for head, tail in (word.split() for word in SPLIT_WORDS)
) + ")"


def spaced(text: Column) -> Column:
    """Lower case; everything but ``a-z 0-9 # +`` becomes a blank; ``#`` stands alone."""
    # The POSIX class is ASCII only, as a-z0-9 is, but matches several times faster.
    kept = F.regexp_replace(F.lower(text), r"[^\p{Alnum}#+ ]", " ")
    alone = F.replace(kept, F.lit("#"), F.lit(" # "))
    return F.regexp_replace(alone, _SPLIT_PATTERN, "$0 ")


def tokens(text: Column) -> Column:
    """Tokens of the cleaned text, stop words included."""
    return F.filter(F.split(spaced(text), " +"), lambda t: t != "")


def without_stop_words(words: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    listed = list(stop_words)
    return F.filter(words, lambda t: ~t.isin(listed)) if listed else words


def clean_text(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """The whole cleaning chain but for lemmas, as one string."""
    listed = ["", *stop_words]
    words = F.filter(F.split(spaced(text), " +"), lambda t: ~t.isin(listed))
    return F.array_join(words, " ")


def vector_terms(clean: Column) -> Column:
    """Terms the vectoriser sees in cleaned text: word runs of two characters or more."""
    return F.filter(F.split(clean, "[ #+]+"), lambda t: F.length(t) >= 2)


def word_terms(text: Column) -> Column:
    """Terms the vectoriser sees in raw text, in any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
