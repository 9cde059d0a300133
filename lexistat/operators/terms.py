"""Cleaned documents, inverted index, document frequencies and TF-IDF weights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexistat.functions.text import STOP_WORDS, SUFFIX_RULES, clean_text
from lexistat.operators.ordering import global_index
from lexistat.session import HOME, TEXT_BYTES, few_splits, home, homes, shuffle_parts, spread, stage, stage_homes

BLOCK_DOCUMENTS = 4096
PIECE_WORDS = 128  # of a text whose words are looked up together, one after the other


def cleaned(
    docs: DataFrame, text: str = "text", key: str = "doc_id",
    stop_words: Iterable[str] = STOP_WORDS, lemmas: DataFrame | None = None, place: bool = False,
    block: int | None = None, at: Column | None = None,
) -> DataFrame:
    """``(key, clean)``: cleaned text, with lemmas from ``lemmas(token, lemma)`` if given.

    With ``place`` the rows come hashed by ``key``; with ``block`` they come hashed by ranges of so many ids,
    whose number is a third column ``block``; with ``at`` they come by that home, a third column ``HOME``, in as
    many partitions as ``homes(docs)`` says. A large table is cleaned before it is moved, as cleaning makes
    it smaller.
    """
    docs = docs.select(key, text)
    if lemmas is not None:
        done = _with_lemmas(docs, text, key, stop_words, lemmas)
        return done if at is None else done.withColumn(HOME, at).repartition(homes(docs), HOME)
    small, parts = few_splits(docs), shuffle_parts(docs, TEXT_BYTES) if at is None else homes(docs)
    more = [] if block is None else [F.expr(f"`{key}` div {block}").alias("block")]
    more = more if at is None else [at.alias(HOME)]
    by = HOME if at is not None else key if block is None else "block"
    if small:
        docs = docs.select(key, text, *more).repartition(parts, by)
    clean = docs.select(key, clean_text(F.col(text), stop_words).alias("clean"), *([by] if small and more else more))
    return clean if small or not (place or more) else clean.repartition(parts, by)


def _with_lemmas(
    docs: DataFrame, text: str, key: str, stop_words: Iterable[str], lemmas: DataFrame
) -> DataFrame:
    """Rows of one key are one text, their words in the order of their places.

    Texts are cut into pieces of ``PIECE_WORDS``. Only the distinct tokens of a piece look for their lemmas, and
    only what they find moves to the piece, where words are replaced in place.
    """
    words = F.split(clean_text(F.col(text), stop_words), " ")
    each = spread(docs, key).select(key, F.coalesce(words, F.array(F.lit(""))).alias("words"))
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(PIECE_WORDS))
    cut = F.transform(
        starts, lambda s: F.struct(s.alias("start"), F.array_join(F.slice("words", s + 1, PIECE_WORDS), " ").alias("piece"))
    )
    pieces = stage(each.select(key, F.inline(cut)), "pieces")
    # One lemma per token, the first in order, or a token listed twice would be counted twice.
    known = lemmas.groupBy("token").agg(F.min("lemma").alias("lemma")).where("lemma <> token")
    tokens_of = pieces.select(key, "start", F.explode(F.array_distinct(F.split("piece", " "))).alias("token"))
    found = tokens_of.where("token <> ''").join(known, "token").select(
        key, "start", F.lit(None).cast("string").alias("piece"), F.struct("token", "lemma").alias("pair")
    )
    nothing = F.lit(None).cast(found.schema["pair"].dataType).alias("pair")
    both = pieces.select(key, "start", "piece", nothing).unionByName(found)
    held = both.repartition(shuffle_parts(docs, TEXT_BYTES), key).groupBy(key, "start").agg(
        F.collect_list("piece").alias("pieces"), F.map_from_entries(F.collect_set("pair")).alias("lemma_of")
    )

    def lemma(word: Column) -> Column:
        return F.coalesce(F.try_element_at("lemma_of", word), word)

    def in_places(piece: Column) -> Column:
        words = F.filter(F.split(piece, " "), lambda w: w != "")
        return F.transform(words, lambda w, i: F.struct(i.alias("place"), lemma(w).alias("word")))

    # The pieces of repeated rows that begin at one place are put together word by word.
    alone = F.transform(F.split(F.get("pieces", F.lit(0)), " "), lemma)
    together = F.sort_array(F.flatten(F.transform("pieces", in_places)))["word"]
    done = held.select(
        key, "start", F.array_join(F.when(F.size("pieces") == 1, alone).otherwise(together), " ").alias("piece")
    )
    listed = F.sort_array(F.collect_list(F.struct("start", "piece")))["piece"]
    return done.groupBy(key).agg(F.array_join(listed, " ").alias("clean"))


def suffix_rules(spark: SparkSession, rules: Iterable[tuple[str, str]] = SUFFIX_RULES) -> DataFrame:
    """``(place, suffix, ending)``: what a suffix is replaced by, in the order of preference."""
    rows = [(place, *rule) for place, rule in enumerate(rules)]
    return spark.createDataFrame(rows, "place int, suffix string, ending string")


def suffix_lemmas(tokens: DataFrame, listed: DataFrame, rules: DataFrame) -> DataFrame:
    """``(token, lemma)`` of the distinct ``tokens(token)`` that a rule turns into a listed word.

    Suffixes are tried from the longest to the shortest, those of one length in the order of their
    rules; a result counts only if ``listed(word)`` has it. Tokens without such a rule have no row, so
    that cleaning leaves them as they are. Each token meets the rules by an equality join on its suffixes, no
    longer than the longest of a rule, and the words by one on the results.
    """
    longest = rules.agg(F.coalesce(F.max(F.length("suffix")), F.lit(0)).alias("longest"))
    each = tokens.select("token").where("token is not null").distinct().join(F.broadcast(longest))
    sizes = F.when(
        F.least("longest", F.length("token") - 1) > 0,
        F.sequence(F.lit(1), F.least("longest", F.length("token") - 1)),
    )
    cut = each.select("token", F.explode(sizes).alias("size")).select(
        "token", "size", F.expr("right(token, size)").alias("suffix"),
        F.expr("left(token, length(token) - size)").alias("stem"),
    )
    results = cut.join(rules, "suffix").select(
        "token", "size", "place", F.concat("stem", "ending").alias("lemma")
    )
    known = results.join(listed.select(F.col("word").alias("lemma")), "lemma", "left_semi")
    best = F.min(F.struct(-F.col("size"), "place", "lemma")).alias("best")
    return known.groupBy("token").agg(best).select("token", "best.lemma")


def term_counts(
    docs: DataFrame, terms: Column, key: str = "doc_id", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(key, carry, term, tf)``: the inverted index in long form.

    On rows hashed by ``key`` this needs no shuffle: the text has moved once, as one row, before
    it is split into many. Columns to ``carry`` along are constant per document.
    """
    rows = docs.select(key, *carry, F.explode(terms).alias("term")).where(F.col("term") != "")
    return rows.groupBy(key, *carry, "term").agg(F.count("*").alias("tf"))


def postings(counts: DataFrame, key: str = "doc_id", block: int = BLOCK_DOCUMENTS) -> DataFrame:
    """``(term, block, postings)``: ids in order, one entry per occurrence.

    A term's list is cut by ranges of ``block`` ids, so a term that is in every document gives
    many short lists and not one that grows with the table. Counts that carry their ``block`` along, hashed
    by it, are listed where they are.
    """
    entry = F.struct(F.col(key).alias("id"), "tf")
    of = F.col("block") if "block" in counts.columns else F.expr(f"`{key}` div {block}").alias("block")
    lists = (
        counts.groupBy("term", of)
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )
    repeated = F.transform("entries", lambda e: F.array_repeat(e["id"], e["tf"].cast("int")))
    return lists.select("term", "block", F.flatten(repeated).alias("postings"))


def frequencies(counts: DataFrame) -> DataFrame:
    """Number of documents and of occurrences of each term."""
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def document_frequencies(docs: DataFrame, terms: Column) -> DataFrame:
    """``(term, df)`` straight from the texts: repeats go inside the row, counts before the
    shuffle."""
    each = docs.select(F.explode(F.array_distinct(terms)).alias("term"))
    return each.where(F.col("term") != "").groupBy("term").agg(F.count("*").alias("df"))


def fit_idf(docs: DataFrame, terms: Column, key: str = "doc_id") -> DataFrame:
    """``(term, df, idf)`` with ``idf = ln((1 + n) / (1 + df)) + 1``, staged.

    Staging gives the table a known size, on which ``for_lookup`` decides.
    """
    n = docs.agg(F.count(key).alias("n")).scalar()
    idf = F.ln((n + 1) / (F.col("df") + 1)) + 1
    return stage(document_frequencies(docs, terms).withColumn("idf", idf), "idf")


def counted_idf(counts: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """``fit_idf`` from the counts ``(HOME, key, term, tf)`` of a corpus and the ids of all its documents."""
    return added_idf(counts.where("tf > 0").groupBy(HOME, "term").agg(F.count("*").alias("df")), ids, parts)


def added_idf(local: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """``fit_idf`` from the document frequencies ``(term, df)`` of all homes."""
    n = ids.agg(F.count(ids.columns[0]).alias("n")).scalar()
    idf = F.ln((n + 1) / (F.col("df") + 1)) + 1
    seen = local.repartition(parts, "term").groupBy("term").agg(F.sum("df").alias("df"))
    return stage(seen.withColumn("idf", idf), "idf")


def at_homes(counts: DataFrame, parts: int, table: DataFrame | None = None) -> DataFrame:
    """``counts`` that lie at their homes, staged there with empty columns for what ``looked_up`` is to find."""
    kinds = {"idf": "double"} if table is None else {f.name: f.dataType for f in table.schema if f.name != "term"}
    return stage_homes(counts.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items()}), "counts", parts)


def homed_counts(
    docs: DataFrame, terms: Column, key: str = "doc_id", carry: tuple[str, ...] = (),
    table: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """``term_counts`` of texts that move once, ``at_homes``, and the number of homes."""
    parts = homes(docs)
    moved = docs.withColumn(HOME, home(docs.sparkSession, F.col(key), parts)).repartition(parts, HOME)
    return at_homes(term_counts(moved, terms, key, (HOME, *carry)), parts, table), parts


def looked_up(counts: DataFrame, table: DataFrame, parts: int) -> DataFrame:
    """``counts`` with the columns of ``table(term, ...)``, one row per term, filled; null where it has none.

    The counts stay at home: only the distinct terms of a home move to the table, and what they find moves
    back. A term that is in every document so moves once per home, and no task holds more than a home
    or a ``parts``-th of the terms. What is found meets the counts in a union, whose sides lie alike; of a join on
    home and term the planner would shuffle both sides.
    """
    columns = [c for c in table.columns if c != "term"]
    wanted = counts.select(HOME, "term").distinct().repartition(parts, "term")
    found = wanted.join(table.repartition(parts, "term"), "term").repartition(parts, HOME)
    own = [f for f in counts.schema if f.name not in (HOME, *table.columns)]
    found = found.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in own])
    same = Window.partitionBy(HOME, "term")
    held = {c: F.first(c, ignorenulls=True).over(same) for c in columns}
    return counts.unionByName(found).withColumns(held).where("tf is not null")


def counted_weights(
    docs: DataFrame, terms: Column, key: str = "doc_id", carry: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(weights, idf)`` of a corpus whose texts are read once: the counts are staged, and both come from them."""
    counts, parts = homed_counts(docs, terms, key, carry)
    idf = counted_idf(counts, docs.select(key), parts)
    return weighted(counts, for_lookup(idf), key, parts).drop(HOME), idf


def for_lookup(idf: DataFrame) -> DataFrame:
    """The fitted vocabulary as the planner takes it.

    It is a written table of known size, which meets the distinct terms of every home.
    """
    return idf.select("term", "idf")


def normalised(counts: DataFrame, idf: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``counts`` with weights ``w``: ``tf * idf`` divided by their Euclidean length per document."""
    return _unit_length(counts.join(idf, "term", how), key)


def weighted(counts: DataFrame, table: DataFrame, key: str, parts: int, how: str = "inner") -> DataFrame:
    """``normalised`` for counts ``at_homes``, which stay there; other columns of the table come along."""
    rows = looked_up(counts, table, parts)
    return _unit_length(rows if how == "left" else rows.where("idf is not null"), HOME, key)


def _unit_length(rows: DataFrame, *document: str) -> DataFrame:
    raw = rows.withColumn("w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*document)))
    return raw.withColumn("w", F.col("w") / F.nullif(length, F.lit(0.0))).drop("idf")


def tfidf_weights(
    docs: DataFrame, terms: Column, idf: DataFrame, key: str = "doc_id",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, carry, term, tf, w)``; terms outside the fitted vocabulary are dropped."""
    counts, parts = homed_counts(docs, terms, key, carry)
    return weighted(counts, for_lookup(idf), key, parts).drop(HOME)


def vocabulary(frequencies: DataFrame) -> DataFrame:
    """``(term, column)``: every term with its 0-based place in alphabetical order.

    The terms are staged first: the range sort reads its input twice, and the texts should not be.
    """
    listed = stage(frequencies.select("term"), "vocabulary")
    return global_index(listed, [F.col("term")], "column", start=0)
