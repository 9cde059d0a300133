import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexistat.operators import search, terms
from lexistat.session import shared_folder
from lexistat.sources.publications import write_postings
from tests.test_text import plain_clean

DOCS = [
    (1, "Bank lending and monetary policy"),
    (2, "Bank risk: lending, lending, lending"),
    (3, "C# and C++ for finance"),
    (4, "The of and"),
    (5, "x ray spectra"),
    (6, "Monetary union + fiscal union"),
    (7, "unrelated words entirely"),
]
QUERIES = [
    (1, "bank lending"), (2, "c#"), (3, "the of"), (4, "zebra"), (5, "lending lending policy"),
    (6, "x"), (7, "entirely"),
]


def vector(text):
    import re

    return Counter(re.findall(r"[a-z0-9]{2,}", plain_clean(text)))


def brute(docs, query):
    counts = {i: vector(t) for i, t in docs}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}

    def weights(c):
        w = {t: n * idf[t] for t, n in c.items() if t in idf}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()} if length else {}

    wanted = set(plain_clean(query).split())
    q = weights(vector(query))
    scored = []
    for i, text in docs:
        if wanted & set(plain_clean(text).split()):
            d = weights(counts[i])
            scored.append((i, sum(q[t] * d.get(t, 0) for t in q)))
    return sorted(scored, key=lambda s: (-round(s[1], 12), s[0]))


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


@pytest.fixture(scope="module")
def built(corpus):
    return search.build_index(corpus)


def test_scores_match_brute_force(spark, built):
    asked = spark.createDataFrame(QUERIES, "query_id int, query string")
    found = search.scores(built[0], search.query_terms(asked, built[1])).collect()
    for number, query in QUERIES:
        ours = {r["doc_id"]: r["score"] for r in found if r["query_id"] == number}
        theirs = dict(brute(DOCS, query))
        assert ours.keys() == theirs.keys()
        assert all(ours[i] == pytest.approx(theirs[i], abs=1e-12) for i in theirs)


def test_pages_cut_the_ranking_without_gap_or_overlap(spark, built, corpus):
    wanted = [i for i, _ in brute(DOCS, "bank lending monetary union")]
    pages = []
    for page in (1, 2, 3):
        results, totals = search.search(
            corpus, *built, "bank lending monetary union", page=page, size=2
        )
        pages += [r["doc_id"] for r in results.collect()]
        assert totals.first()["total"] == len(wanted)
        assert totals.first()["pages"] == math.ceil(len(wanted) / 2)
    assert pages == wanted


def test_blank_query_gives_everything_in_order(built, corpus):
    results, totals = search.search(corpus, *built, "  ", page=2, size=3)
    assert [r["doc_id"] for r in results.collect()] == [4, 5, 6]
    assert totals.first().asDict() == {"page": 2, "size": 3, "total": 7, "pages": 3}


def test_query_without_candidates_has_one_empty_page(built, corpus):
    results, totals = search.search(corpus, *built, "zebra")
    assert results.collect() == []
    assert totals.first().asDict() == {"page": 1, "size": 30, "total": 0, "pages": 1}


def test_page_numbers_start_at_one(built, corpus):
    with pytest.raises(ValueError):
        search.search(corpus, *built, "bank", page=0)


def test_last_document_can_be_found(built, corpus):
    results, _ = search.search(corpus, *built, "entirely")
    assert [r["doc_id"] for r in results.collect()] == [7]


def test_stored_index_gives_the_same_scores(spark, built, tmp_path):
    search.write_index(*built, str(tmp_path))
    index, idf = search.read_index(spark, str(tmp_path))
    asked = spark.createDataFrame(QUERIES, "query_id int, query string")

    def rows(i, f):
        found = search.scores(i, search.query_terms(asked, f))
        return {(r["query_id"], r["doc_id"]): r["score"] for r in found.collect()}

    ours, theirs = rows(index, idf), rows(*built)
    assert ours.keys() == theirs.keys()
    assert all(ours[k] == pytest.approx(theirs[k], abs=1e-12) for k in theirs)


def test_sort_merge_route_gives_the_same_scores(spark, built, corpus):
    asked = spark.createDataFrame(QUERIES, "query_id int, query string")

    def rows(index, idf):
        found = search.scores(index, search.query_terms(asked, idf)).collect()
        return {(r["query_id"], r["doc_id"]): round(r["score"], 12) for r in found}

    wanted = rows(*built)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for name in names:
            spark.conf.set(name, "-1")
        assert rows(*search.build_index(corpus)) == wanted
    finally:
        for name in names:
            spark.conf.unset(name)


def test_weights_have_unit_length(corpus):
    clean = terms.cleaned(corpus)
    words = F.filter(F.split("clean", " "), lambda t: F.length(t) >= 2)
    weights = terms.tfidf_weights(clean, words, terms.fit_idf(clean, words))
    lengths = weights.groupBy("doc_id").agg(F.sum(F.col("w") * F.col("w")).alias("l")).collect()
    assert lengths and all(r["l"] == pytest.approx(1.0) for r in lengths)


def test_postings_repeat_an_id_per_occurrence_in_blocks(spark, corpus, tmp_path):
    counts = terms.term_counts(terms.cleaned(corpus), F.split("clean", " "))
    lists = terms.postings(counts, block=2)
    found = {(r["term"], r["block"]): r["postings"] for r in lists.collect()}
    assert found[("lending", 0)] == [1]
    assert found[("lending", 1)] == [2, 2, 2]
    assert found[("union", 3)] == [6, 6]
    write_postings(lists, str(tmp_path / "index"))
    back = spark.read.json(str(tmp_path / "index"))
    assert back.where("term = 'lending' and block = 1").first()["postings"] == [2, 2, 2]


def test_lemmas_replace_tokens_in_place(spark, corpus):
    lemmas = spark.createDataFrame([("lending", "lend"), ("words", "word")], "token string, lemma string")
    clean = {r["doc_id"]: r["clean"] for r in terms.cleaned(corpus, lemmas=lemmas).collect()}
    assert clean[2] == "bank risk lend lend lend"
    assert clean[4] == ""
    assert clean[7] == "unrelated word entirely"


def test_vocabulary_is_ranked_alphabetically(spark, corpus):
    counts = terms.term_counts(terms.cleaned(corpus), F.split("clean", " "))
    ranked = terms.vocabulary(terms.frequencies(counts)).collect()
    by_place = [r["term"] for r in sorted(ranked, key=lambda r: r["column"])]
    assert by_place == sorted(by_place) and [r for r in range(len(by_place))] == sorted(
        r["column"] for r in ranked
    )


def test_shared_folder_is_named_by_the_session(spark):
    assert shared_folder(spark)


def test_deep_pages_equal_a_full_ranking(spark):
    scored = spark.range(3000).select(
        (F.col("id") % 2).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 7).alias("score")
    )
    for page, size in ((1, 40), (2, 600), (3, 500)):
        got = {(r["query_id"], r["rank"]): r["doc_id"] for r in search.ranked_page(scored, page, size).collect()}
        for query in (0, 1):
            order = sorted((i for i in range(3000) if i % 2 == query), key=lambda i: (-(i % 7), i))
            wanted = {(query, k + 1): i for k, i in enumerate(order) if (page - 1) * size <= k < page * size}
            assert {k: v for k, v in got.items() if k[0] == query} == wanted


def test_a_token_with_two_lemmas_counts_once(spark):
    docs = spark.createDataFrame([(1, "mice run")], "doc_id long, text string")
    lemmas = spark.createDataFrame([("mice", "mouse"), ("mice", "mice")], "token string, lemma string")
    assert terms.cleaned(docs, lemmas=lemmas).first()["clean"] == "mice run"
