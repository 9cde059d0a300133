"""Pruned search, indexes in segments and lemmas by rules."""

import random

import pytest
from pyspark.sql import functions as F

from lexistat.operators import search, segments, terms, topk
from lexistat.session import shared_folder

FOLDER = "/root/testdata/sf0.01"


def blocks(index, width):
    postings = topk.blocked(index, width=width)
    return postings, topk.block_tops(postings)


def page(scored, size):
    even = scored.withColumn("score", F.round("score", 12))
    return sorted(tuple(r) for r in search.ranked_page(even, 1, size).select("query_id", "rank", "doc_id", "score").collect())


def test_pages_are_equal_and_far_fewer_pairs_are_scored(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    index, idf = search.build_index(docs)
    asked = search.query_terms(items.selectExpr("item_id AS query_id", "text AS query"), idf)
    pruned = topk.pruned_scores(*blocks(index, topk.WIDTH), asked, 10)
    every = search.scores(index, asked)
    assert page(pruned.scored, 10) == page(every, 10)
    assert 3 * pruned.pairs.count() <= every.count()


@pytest.mark.parametrize("width, wanted", [(1, 1), (2, 3), (4, 3), (64, 10)])
def test_ties_and_queries_that_find_little(spark, width, wanted):
    """Copies tie in every query; some queries find fewer than are wanted, or nothing."""
    chance = random.Random(width)
    words = ["alpha", "beta", "gamma", "delta", "x", "c#", "a+b", "omega"]
    texts = [" ".join(chance.choices(words, k=chance.randrange(1, 12))) for _ in range(60)]
    docs = spark.createDataFrame([(i, texts[i % 40]) for i in range(120)] + [(500, None), (501, "")], "doc_id bigint, text string")
    queries = [(1, "alpha"), (2, "beta gamma delta delta"), (3, "x"), (4, "c#"), (5, "a+b omega"), (6, "zebra"), (7, "")]
    index, idf = search.build_index(docs)
    asked = search.query_terms(spark.createDataFrame(queries, "query_id int, query string"), idf)
    pruned = topk.pruned_scores(*blocks(index, width), asked, wanted)
    assert page(pruned.scored, wanted) == page(search.scores(index, asked), wanted)


def test_stored_index_gives_the_same_pages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 200")
    index, idf = search.build_index(docs)
    search.write_index(index, idf, str(tmp_path / "index"))
    read, stored_idf = search.read_index(spark, str(tmp_path / "index"))
    assert sorted(read.columns) == sorted(index.columns) and read.count() == index.count()
    asked = search.query_terms(spark.createDataFrame([(1, "the tion of"), (2, "th er an")], "query_id int, query string"), stored_idf)
    pruned = search.stored_scores(spark, str(tmp_path / "index"), asked, 5)
    assert page(pruned.scored, 5) == page(search.scores(index, asked), 5)


def rounded(index):
    return sorted(
        (r["doc_id"], r["term"], r["n"], r["tf"], None if r["w"] is None else round(r["w"], 12)) for r in index.collect()
    )


def same(spark, folder, docs):
    index, idf = segments.read(spark, folder)
    fresh, fresh_idf = search.build_index(docs)
    assert rounded(index) == rounded(fresh)
    assert sorted((r["term"], r["df"]) for r in idf.collect()) == sorted((r["term"], r["df"]) for r in fresh_idf.collect())


def test_segments_read_as_one_index(spark, tmp_path):
    folder = f"{shared_folder(spark)}/segments-{tmp_path.name}"
    schema = "doc_id bigint, text string"
    base = spark.createDataFrame([(1, "bank lending"), (2, "bank risk risk"), (3, ""), (4, "union c#")], schema)
    segments.add(base, folder)
    same(spark, folder, base)
    segments.add(spark.createDataFrame([(5, "lending union bank"), (6, None)], schema), folder)
    segments.delete(spark.createDataFrame([(2,), (4,), (None,), (99,)], "doc_id bigint"), folder)
    segments.add(spark.createDataFrame([(4, "fiscal union"), (7, "bank")], schema), folder)
    now = spark.createDataFrame(
        [(1, "bank lending"), (3, ""), (5, "lending union bank"), (6, None), (4, "fiscal union"), (7, "bank")], schema
    )
    same(spark, folder, now)
    number = segments.compact(spark, folder)
    assert segments.version(spark, folder).parts == (number,) and segments.version(spark, folder).deletions == ()
    same(spark, folder, now)
    segments.delete(spark.createDataFrame([(7,)], "doc_id bigint"), folder)
    same(spark, folder, now.where("doc_id <> 7"))


def test_an_unfinished_segment_is_not_read(spark, tmp_path, monkeypatch):
    folder = f"{shared_folder(spark)}/unfinished-{tmp_path.name}"
    docs = spark.createDataFrame([(1, "bank lending")], "doc_id bigint, text string")
    segments.add(docs, folder)

    def lost(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as patch:
        patch.setattr(segments, "_commit", lost)
        with pytest.raises(RuntimeError):
            segments.add(spark.createDataFrame([(2, "half written")], "doc_id bigint, text string"), folder)
    same(spark, folder, docs)
    segments.add(spark.createDataFrame([(2, "written anew")], "doc_id bigint, text string"), folder)
    assert sorted(r["term"] for r in segments.read(spark, folder)[1].collect()) == ["anew", "bank", "lending", "written"]


def test_empty_index(spark, tmp_path):
    index, idf = segments.read(spark, f"{shared_folder(spark)}/none-{tmp_path.name}")
    assert index.collect() == [] and idf.collect() == []


def test_lemmas_by_the_longest_listed_suffix(spark):
    words = ["bank", "bus", "box", "city", "woman", "make", "walk", "large", "wolf", "analysis", "pass"]
    tokens = ["banks", "buses", "boxes", "cities", "women", "making", "walked", "walking", "larger", "largest", "wolves",
              "analyses", "zebras", "s", "bank", "passes", None]
    found = terms.suffix_lemmas(
        spark.createDataFrame([(t,) for t in tokens], "token string"),
        spark.createDataFrame([(w,) for w in words], "word string"), terms.suffix_rules(spark),
    )
    # analyses: the noun rule gives analys, which is not listed. A token without a listed result has no row.
    assert {r["token"]: r["lemma"] for r in found.collect()} == {
        "banks": "bank", "buses": "bus", "boxes": "box", "cities": "city", "women": "woman", "making": "make",
        "walked": "walk", "walking": "walk", "larger": "large", "largest": "large", "wolves": "wolf", "passes": "pass",
    }


def test_words_without_a_rule_stay(spark):
    docs = spark.createDataFrame([(1, "Banks lend zebras"), (2, None)], "doc_id bigint, text string")
    lemmas = terms.suffix_lemmas(
        spark.createDataFrame([("banks",), ("zebras",)], "token string"),
        spark.createDataFrame([("bank",)], "word string"), terms.suffix_rules(spark),
    )
    clean = {r["doc_id"]: r["clean"] for r in terms.cleaned(docs, lemmas=lemmas).collect()}
    assert clean == {1: "bank lend zebras", 2: ""}
