"""Cleaning, indexing and ranked search over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions.text import STOP_WORDS, SUFFIX_RULES, tokens, vector_terms, without_stop_words
from lexistat.operators import search, segments, terms
from lexistat.plans import sql
from lexistat.session import own_folder, spread, stage
from lexistat.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

ASKED = (
    (1, "The tion of rewh"),
    (2, "thing Tion, tion -- thble?"),
    (3, "###"),
    (4, "zzzz qqqq"),
    (5, "the of and"),
    (6, "n eau"),
    (7, "ch; und +1"),
)
ASKED_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{text}')" for i, text in ASKED
) + ") AS asked(query_id, query)"
WITH_QUERIES = f"WITH {sql.INDEX}, {sql.queries(ASKED_SQL)}"
BLOCK = 256
PAGE = 10


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def _asked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ASKED), "query_id int, query string")


_stored: dict[tuple[str, str], str] = {}


def _index_path(spark: SparkSession, folder: str) -> str:
    """The index of a folder's documents, built by the first search of the application and kept for the others."""
    place = (spark.sparkContext.applicationId, folder)
    if place not in _stored:
        _stored[place] = _build(spark, folder)
    return _stored[place]


def _build(spark: SparkSession, folder: str) -> str:
    path = own_folder(spark, "index")
    search.store_index(_documents(spark, folder), path)
    return path


def _index(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return search.read_index(spark, _index_path(spark, folder))


def _scores(spark: SparkSession, folder: str, asked: DataFrame | None = None) -> DataFrame:
    index, idf = _index(spark, folder)
    return search.scores(index, search.query_terms(asked or _asked(spark), idf))


def _best(spark: SparkSession, folder: str, asked: DataFrame, wanted: int) -> DataFrame:
    """The scores that the best ``wanted`` documents need."""
    path = _index_path(spark, folder)
    terms_of = search.query_terms(asked, search.read_index(spark, path)[1])
    return search.stored_scores(spark, path, terms_of, wanted).scored


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return terms.cleaned(_documents(spark, folder))


QUERIES["clean_text"] = clean_text
ORACLES["clean_text"] = f"""
SELECT doc_id, array_to_string({sql.clean_tokens('text')}, ' ') AS clean FROM documents
"""


def stopword_filter(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(_documents(spark, folder), "doc_id")
    words = docs.select("doc_id", tokens(F.col("text")).alias("words"))
    return words.select(
        "doc_id", F.size("words").alias("tokens"),
        F.size(without_stop_words(F.col("words"), STOP_WORDS)).alias("kept"),
    )


QUERIES["stopword_filter"] = stopword_filter
ORACLES["stopword_filter"] = f"""
WITH t AS (
  SELECT doc_id, {sql.clean_tokens('text')} AS kept,
         list_filter(string_split_regex(
           replace(regexp_replace(lower(text), '[^a-z0-9#+]', ' ', 'g'), '#', ' # '), ' +'),
           lambda t: t <> '') AS words
  FROM documents)
SELECT doc_id, len(words)::INT AS tokens, len(kept)::INT AS kept FROM t
"""


def lemma_join(spark: SparkSession, folder: str) -> DataFrame:
    """Lemmas by table: here every token of the corpus that ends in ``s`` loses it."""
    docs = _documents(spark, folder)
    seen = terms.cleaned(docs).select(F.explode(F.split("clean", " ")).alias("token")).distinct()
    plural = F.col("token").rlike("^[a-z]{3,}s$")
    lemmas = seen.where(plural).select("token", F.regexp_replace("token", "s$", "").alias("lemma"))
    return terms.cleaned(docs, lemmas=lemmas)


QUERIES["lemma_join"] = lemma_join
ORACLES["lemma_join"] = f"""
SELECT doc_id, array_to_string(list_transform({sql.clean_tokens('text')},
         lambda t: CASE WHEN regexp_matches(t, '^[a-z]{{3,}}s$') THEN left(t, len(t) - 1) ELSE t END),
         ' ') AS clean
FROM documents
"""


def lemma_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Lemmas by suffix rules: a result counts where the corpus itself has it as a token."""
    docs = _documents(spark, folder)
    words = terms.cleaned(docs).select(F.explode(F.split("clean", " ")).alias("token"))
    seen = stage(words.where("token != ''").distinct(), "seen")
    lemmas = terms.suffix_lemmas(seen, seen.withColumnRenamed("token", "word"), terms.suffix_rules(spark))
    return terms.cleaned(docs, lemmas=lemmas)


QUERIES["lemma_rules"] = lemma_rules
ORACLES["lemma_rules"] = f"""
WITH cl AS (SELECT doc_id, {sql.clean_tokens('text')} AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS token, generate_subscripts(words, 1) AS place FROM cl),
seen AS (SELECT DISTINCT token FROM w),
rules(place, suffix, ending) AS (VALUES {', '.join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(SUFFIX_RULES))}),
made AS (SELECT token, left(token, len(token) - len(suffix)) || ending AS lemma,
                row_number() OVER (PARTITION BY token ORDER BY len(suffix) DESC, place) AS k
         FROM seen JOIN rules ON ends_with(token, suffix) AND len(token) > len(suffix)
         WHERE left(token, len(token) - len(suffix)) || ending IN (SELECT token FROM seen)),
done AS (SELECT doc_id, string_agg(coalesce(lemma, w.token), ' ' ORDER BY w.place) AS clean
         FROM w LEFT JOIN made ON made.token = w.token AND k = 1 GROUP BY doc_id)
SELECT doc_id, coalesce(clean, '') AS clean FROM documents LEFT JOIN done USING (doc_id)
"""


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    clean = terms.cleaned(_documents(spark, folder), place=True)
    return terms.term_counts(clean, F.split("clean", " "))


def inverted_index(spark: SparkSession, folder: str) -> DataFrame:
    clean = terms.cleaned(_documents(spark, folder), block=BLOCK)
    lists = terms.postings(terms.term_counts(clean, F.split("clean", " "), carry=("block",)), block=BLOCK)
    ids = F.transform("postings", lambda i: i.cast("string"))
    return lists.select("term", "block", F.array_join(ids, ",").alias("postings"))


QUERIES["inverted_index"] = inverted_index
ORACLES["inverted_index"] = f"""
WITH p AS (SELECT doc_id, unnest({sql.clean_tokens('text')}) AS term FROM documents)
SELECT term, (doc_id // {BLOCK})::BIGINT AS block,
       string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS postings
FROM p GROUP BY ALL
"""


def doc_freq(spark: SparkSession, folder: str) -> DataFrame:
    return terms.frequencies(_counts(spark, folder))


QUERIES["doc_freq"] = doc_freq
ORACLES["doc_freq"] = f"""
WITH p AS (SELECT doc_id, unnest({sql.clean_tokens('text')}) AS term FROM documents)
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM p GROUP BY term
"""


def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    clean = terms.cleaned(_documents(spark, folder))
    weights, _ = terms.counted_weights(clean, vector_terms(F.col("clean")))
    return weights.select("doc_id", "term", "tf", F.round("w", 6).alias("w"))


QUERIES["tfidf_weights"] = tfidf_weights
ORACLES["tfidf_weights"] = f"WITH {sql.INDEX} SELECT doc_id, term, tf, round(w, 6) AS w FROM w"


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    clean = terms.cleaned(_documents(spark, folder))
    return terms.vocabulary(terms.document_frequencies(clean, vector_terms(F.col("clean"))))


QUERIES["vocabulary"] = vocabulary
ORACLES["vocabulary"] = f"""
WITH {sql.INDEX}
SELECT term, row_number() OVER (ORDER BY term) - 1 AS "column" FROM idf
"""


def query_weights(spark: SparkSession, folder: str) -> DataFrame:
    clean = terms.cleaned(_documents(spark, folder))
    idf = terms.fit_idf(clean, vector_terms(F.col("clean")))
    asked = search.query_terms(_asked(spark), idf).where("w is not null")
    return asked.select("query_id", "term", F.round("w", 6).alias("w"))


QUERIES["query_weights"] = query_weights
ORACLES["query_weights"] = f"{WITH_QUERIES} SELECT query_id, term, round(w, 6) AS w FROM qw"


def search_candidates(spark: SparkSession, folder: str) -> DataFrame:
    index, idf = _index(spark, folder)
    return search.candidates(index, search.query_terms(_asked(spark), idf))


QUERIES["search_candidates"] = search_candidates
ORACLES["search_candidates"] = f"{WITH_QUERIES} SELECT query_id, doc_id FROM cand"


def search_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).select("query_id", "doc_id", F.round("score", 6).alias("score"))


QUERIES["search_scores"] = search_scores
ORACLES["search_scores"] = (
    f"{WITH_QUERIES} SELECT query_id, doc_id, round(score, 6) AS score FROM sc"
)


def _page(scored: DataFrame, page: int) -> DataFrame:
    # Scores that agree to twelve places are equal; their order is the order of the ids.
    even = scored.withColumn("score", F.round("score", 12))
    return search.ranked_page(even, page, PAGE).select(
        "query_id", "doc_id", "rank", F.round("score", 6).alias("score")
    )


def _page_sql(page: int) -> str:
    return f"""{WITH_QUERIES},
rr AS (SELECT query_id, doc_id, score,
              row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, doc_id) AS rank
       FROM sc)
SELECT query_id, doc_id, rank::INT AS rank, round(score, 6) AS score
FROM rr WHERE rank > {(page - 1) * PAGE} AND rank <= {page * PAGE}
"""


def search_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _page(_best(spark, folder, _asked(spark), PAGE), 1)


QUERIES["search_topk"] = search_topk
ORACLES["search_topk"] = _page_sql(1)


def stored_index_search(spark: SparkSession, folder: str) -> DataFrame:
    """The same page from an index that is built and written for it, every score of it."""
    index, idf = search.read_index(spark, _build(spark, folder))
    return _page(search.scores(index, search.query_terms(_asked(spark), idf)), 1)


QUERIES["stored_index_search"] = stored_index_search
ORACLES["stored_index_search"] = _page_sql(1)


def segmented_search(spark: SparkSession, folder: str) -> DataFrame:
    """The same page from an index that grew by two segments, with documents deleted and added anew."""
    docs, doc = _documents(spark, folder), F.abs("doc_id")
    path = own_folder(spark, "segments")
    segments.add(docs.where(doc % 2 == 0), path)
    segments.delete(docs.where(doc % 10 == 0), path)
    segments.add(docs.where((doc % 4 == 1) | (doc % 10 == 0)), path)
    segments.add(docs.where(doc % 4 == 3), path)
    index, idf = segments.read(spark, path)
    return _page(search.scores(index, search.query_terms(_asked(spark), idf)), 1)


QUERIES["segmented_search"] = segmented_search
ORACLES["segmented_search"] = _page_sql(1)


def search_page2(spark: SparkSession, folder: str) -> DataFrame:
    return _page(_best(spark, folder, _asked(spark), 2 * PAGE), 2)


QUERIES["search_page2"] = search_page2
ORACLES["search_page2"] = _page_sql(2)


DEEP_SIZE = 600
DEEP_QUERY = "th er an on in ti re es en ed or nd at ing ha der die le la de el que"


def search_deep_page(spark: SparkSession, folder: str) -> DataFrame:
    """A page whose last rank is 1,200: beyond what a window serves without gathering a query's hits."""
    asked = table(spark, folder, "documents").select(F.lit(1).alias("query_id"), F.lit(DEEP_QUERY).alias("query"))
    even = _scores(spark, folder, asked.limit(1)).withColumn("score", F.round("score", 12))
    return search.ranked_page(even, 2, DEEP_SIZE).select(
        "query_id", "doc_id", "rank", F.round("score", 6).alias("score")
    )


QUERIES["search_deep_page"] = search_deep_page
ORACLES["search_deep_page"] = (
    _page_sql(1)
    .replace(ASKED_SQL, f"SELECT 1 AS query_id, '{DEEP_QUERY}' AS query")
    .replace(f"rank > 0 AND rank <= {PAGE}", f"rank > {DEEP_SIZE} AND rank <= {2 * DEEP_SIZE}")
)


def page_totals(spark: SparkSession, folder: str) -> DataFrame:
    return search.page_totals(_scores(spark, folder), _asked(spark), 1, search.PAGE_SIZE)


QUERIES["page_totals"] = page_totals
ORACLES["page_totals"] = f"""{WITH_QUERIES}
SELECT q.query_id, 1 AS page, {search.PAGE_SIZE} AS size, count(doc_id) AS total,
       greatest(ceil(count(doc_id) / {search.PAGE_SIZE}.0)::BIGINT, 1) AS pages
FROM q LEFT JOIN sc USING (query_id) GROUP BY q.query_id
"""


def blank_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    results, _ = search.search(docs, None, None, "  ", page=2)
    return results.select("doc_id", "lang", "source", "text")


QUERIES["blank_query"] = blank_query
ORACLES["blank_query"] = f"""
SELECT doc_id, lang, source, text FROM documents ORDER BY doc_id
LIMIT {search.PAGE_SIZE} OFFSET {search.PAGE_SIZE}
"""


def no_match_query(spark: SparkSession, folder: str) -> DataFrame:
    index, idf = _index(spark, folder)
    _, totals = search.search(_documents(spark, folder), index, idf, "zzzz qqqq")
    return totals


QUERIES["no_match_query"] = no_match_query
ORACLES["no_match_query"] = f"""
WITH hits AS (SELECT count(*) AS total FROM documents
              WHERE list_has_any({sql.clean_tokens('text')}, ['zzzz', 'qqqq']))
SELECT 1 AS page, {search.PAGE_SIZE} AS size, total,
       greatest(ceil(total / {search.PAGE_SIZE}.0)::BIGINT, 1) AS pages FROM hits
"""


def search_records(spark: SparkSession, folder: str) -> DataFrame:
    index, idf = _index(spark, folder)
    docs = table(spark, folder, "documents")
    results, _ = search.search(docs, index, idf, ASKED[0][1], size=PAGE)
    return results.select("doc_id", "lang", "source", "text", F.round("score", 6).alias("score"))


QUERIES["search_records"] = search_records
ORACLES["search_records"] = f"""{WITH_QUERIES}
SELECT d.doc_id, lang, source, text, round(score, 6) AS score
FROM rk JOIN documents d USING (doc_id) WHERE query_id = {ASKED[0][0]} AND rank <= {PAGE}
"""


def benchmark_search(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text as a query: the ten best documents of each."""
    items = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    return _page(_best(spark, folder, items, PAGE), 1)


QUERIES["benchmark_search"] = benchmark_search
ORACLES["benchmark_search"] = _page_sql(1).replace(
    ASKED_SQL, "SELECT item_id AS query_id, text AS query FROM benchmark"
)


def index_build(spark: SparkSession, folder: str) -> DataFrame:
    """An index built and written anew: its terms with their postings, as token and as vectoriser term."""
    index, _ = search.read_index(spark, _build(spark, folder))
    return index.groupBy("term").agg(
        F.count_if(F.col("n") > 0).alias("listed"), F.count_if(F.col("tf") > 0).alias("df")
    )


QUERIES["index_build"] = index_build
ORACLES["index_build"] = f"""
WITH {sql.INDEX}
SELECT term, count(DISTINCT CASE WHEN idx.n > 0 THEN idx.doc_id END) AS listed, coalesce(max(df), 0) AS df
FROM (SELECT term FROM idx UNION SELECT term FROM vec) t
LEFT JOIN idx USING (term) LEFT JOIN (SELECT term, count(*) AS df FROM vec GROUP BY term) d USING (term)
GROUP BY term
"""
