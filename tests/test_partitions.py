"""Partitions hold a bounded share of a table of any size, and of a join no more than its tables give."""

from pyspark.sql import functions as F

from lexistat.operators import search, terms, topk
from lexistat.session import HOME, SORT_BYTES, TEXT_BYTES, known_size, shuffle_parts


def test_a_join_is_as_large_as_its_tables(spark):
    left = spark.range(400_000).withColumnRenamed("id", "doc_id")
    joined = left.join(spark.range(400_000).selectExpr("id AS doc_id", "id AS label"), "doc_id")
    assert known_size(joined) <= 16 * 400_000
    assert shuffle_parts(joined, TEXT_BYTES) == 8


def test_partitions_grow_with_the_table(spark):
    rows = spark.range(1 << 26)
    assert known_size(rows) == 1 << 29
    assert shuffle_parts(rows, TEXT_BYTES) == (1 << 29) // TEXT_BYTES
    assert shuffle_parts(rows) == (1 << 29) // SORT_BYTES


def test_lists_are_made_where_the_texts_of_a_block_are(spark):
    docs = spark.createDataFrame([(i, f"bank {'risk ' * (i % 3)}c{i % 5}") for i in range(40)] + [(None, "bank"), (3, "bank")],
                                 "doc_id bigint, text string")
    placed = terms.cleaned(docs, block=4)
    lists = terms.postings(terms.term_counts(placed, F.split("clean", " "), carry=("block",)), block=4)
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    plain = terms.postings(terms.term_counts(terms.cleaned(docs), F.split("clean", " ")), block=4)
    assert sorted(map(str, lists.collect())) == sorted(map(str, plain.collect()))


def test_lemmas_of_long_and_repeated_texts(spark):
    long = " ".join(f"w{i % 3000}s" for i in range(5000))
    docs = spark.createDataFrame([(1, long), (2, "banks b banks"), (2, "a1 lend"), (3, None), (None, "banks")], "doc_id bigint, text string")
    lemmas = spark.createDataFrame([("banks", "bank"), ("banks", "zank"), ("w7s", "w7"), ("", "x"), ("lend", None)], "token string, lemma string")
    cleaned = terms.cleaned(docs, lemmas=lemmas)
    assert "posexplode" not in cleaned._jdf.queryExecution().executedPlan().toString()
    clean = {r["doc_id"]: r["clean"] for r in cleaned.collect()}
    assert clean == {1: long.replace("w7s", "w7"), 2: "a1 bank b lend bank", 3: "", None: "bank"}


def test_tops_stand_in_the_first_row(spark):
    rows = spark.createDataFrame([(1, "a", 1, 1, 0.5, 0), (2, "a", 0, 1, 0.7, 0), (3, "a", 1, 0, None, 1)],
                                 "doc_id bigint, term string, n bigint, tf bigint, w double, block bigint")
    ranged = rows.repartitionByRange(3, "term", "block")
    found = topk.topped(ranged)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    tops = {tuple(r) for r in found.where("top is not null").select("term", "block", "top", "listed").collect()}
    assert tops == {tuple(r) for r in topk.block_tops(rows).collect()} and found.count() == 3


def moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ENSURE_REQUIREMENTS")


def test_counts_stay_at_their_homes(spark):
    docs = spark.createDataFrame([(i, f"bank {'risk ' * (i % 3)}c{i % 5}") for i in range(40)] + [(None, "bank"), (3, "bank"), (50, None)],
                                 "doc_id bigint, text string")
    counts, parts = terms.homed_counts(terms.cleaned(docs), F.split("clean", " "))
    idf = terms.counted_idf(counts, docs.select("doc_id"), parts)
    weights = terms.weighted(counts, terms.for_lookup(idf), "doc_id", parts)
    assert moves(weights) == 0
    plain = terms.normalised(terms.term_counts(terms.cleaned(docs), F.split("clean", " ")), terms.for_lookup(idf), "doc_id")
    wanted, found = (sorted(map(str, x.select("doc_id", "term", "tf", F.round("w", 9)).collect())) for x in (plain, weights))
    assert found == wanted


def test_an_index_is_stored_where_its_texts_are(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"bank {'risk ' * (i % 3)}c{i % 5}") for i in range(80)], "doc_id bigint, text string")
    rows, idf = search._built(docs, "text", "doc_id", (), None)
    by = (HOME,)
    assert moves(topk.topped(topk.blocked(rows, by=by), by=by)) == 0
    search.store_index(docs, str(tmp_path / "index"), stop_words=())
    read, stored = search.read_index(spark, str(tmp_path / "index"))
    shown = [sorted(map(str, x.select("doc_id", "term", "n", "tf", F.round("w", 9)).collect())) for x in (read, rows)]
    assert shown[0] == shown[1] and sorted(map(str, stored.collect())) == sorted(map(str, idf.collect()))
    asked = search.query_terms(spark.createDataFrame([(1, "risk c3"), (2, "bank")], "query_id int, query string"), stored)
    best = search.stored_scores(spark, str(tmp_path / "index"), asked, 2).scored
    even = [sorted(map(str, search.ranked_page(x.withColumn("score", F.round("score", 9)), 1, 2).collect()))
            for x in (best, search.scores(rows.drop(HOME), asked))]
    assert even[0] == even[1]
