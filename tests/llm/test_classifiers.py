import random

import numpy as np
from pyspark.sql import functions as F

from lexistat.llm import labelled, quality, toxicity

FOLDER = "/root/testdata/sf0.01"


def accuracy(spark, judged, column):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    return judged.filter("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col(column)).cast("double"))
    ).first()[0]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    assert accuracy(spark, quality.judge(docs, labels), "quality") >= 0.97
    assert accuracy(spark, toxicity.judge(docs, labels), "toxic") >= 0.93


def test_bradley_terry_orders_pairs():
    chance = np.random.default_rng(1)
    x = chance.normal(size=(400, 3))
    strength = x @ np.array([2.0, -1.0, 0.0])
    i, j = chance.integers(0, 400, (2, 3000))
    won = strength[i] > strength[j]
    weights = quality.bradley_terry(x[np.where(won, i, j)], x[np.where(won, j, i)])
    assert weights[0] > 0 > weights[1] and abs(weights[2]) < 0.2 * weights[0]
    assert quality.cut(np.array([3.0, 1.0, 2.0, 9.0]), np.ones(4), 0.5) == 2.5


def test_all_labelled_documents_are_ranked(documents, spark):
    """More of a label than the former sample of 5,000 held: each plays, and the threshold is that of all scores."""
    rows = [(i, f"Good text {i}." if i % 4 else f"{i} ## !! {i}") for i in range(24_000)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    model = quality.fit(docs, labels, F.lit(True))
    scores = sorted(r["score"] for r in quality.score(docs, model, F.col("doc_id")).collect())
    assert sum(s < 0.5 for s in scores) == 6_000
    known = spark.range(30).select(F.col("id").alias("doc_id"), (F.col("id") >= 10).cast("int").alias("label"),
                                   F.array(F.col("id").cast("double")).alias("x"))
    for some, low, high in ((known, 10, 20), (known.withColumn("label", 1 - F.col("label")), 20, 10)):
        pairs = [r["d"][0] for r in quality.played(some, low, high, 3).collect()]
        sign = 1 if low == 10 else -1
        assert len(pairs) == 60 and all(d * sign > 0 for d in pairs)
        # Each of the twenty plays three times, each of the ten six times.
        assert sum(pairs) * sign == 3 * sum(range(10, 30)) - 6 * sum(range(10))


def test_steps_over_a_table_are_those_over_arrays(spark):
    chance = np.random.default_rng(2)
    d = chance.normal(size=(300, 3)) + np.array([0.5, 0.0, -0.3])
    table = spark.createDataFrame([([float(v) for v in row],) for row in d], "d array<double>")
    assert np.allclose(quality.ranked(table, np.array([1.0, 2.0, 0.5])), quality.bradley_terry(d / [1.0, 2.0, 0.5], 0 * d))


def biased(documents, spark):
    """Group names occur in toxic texts more often than in clean ones; abuse is what makes them toxic."""
    chance = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 2
        text = [f"w{chance.randrange(20)}" for _ in range(8)]
        if chance.random() < (0.7 if toxic else 0.05):
            text.append("martians")
        if toxic and chance.random() < 0.7:
            text.append("vermin")
        rows.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    # Neutral mentions that carry no label.
    rows += [(10_000 + i, f"martians w{i % 20} w{(7 * i) % 20}") for i in range(100)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_fewer_neutral_mentions_are_taken_for_abuse(documents, spark):
    docs, labels = biased(documents, spark)
    groups = spark.createDataFrame([(1, "Martians"), (1, "venusians"), (2, "x")], "family int, term string")

    def wrong(penalty):
        judged = toxicity.judge(docs, labels, identities=groups, penalty=penalty)
        assert judged.filter("doc_id < 10000").join(labels, "doc_id").filter("toxic = predicted").count() > 600
        return judged.filter("doc_id >= 10000").agg(F.sum("predicted")).first()[0]

    assert wrong(0.0) > 50 and wrong(toxicity.SWAP_PENALTY) == 0


def test_pairs_come_from_texts_without_any_mention_too(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, F.lit(True))
    assert model.n_pairs > 0
    assert toxicity.swapped({"women", "x"}) == {"men", "x"} and toxicity.swapped({"x"}) is None
    groups = spark.createDataFrame([(1, "b"), (1, "A"), (2, None)], "family int, term string")
    assert toxicity.families_in(groups) == [["a", "b"]] or toxicity.families_in(groups) == [["b", "a"]]


def test_few_labels_still_rank(spark):
    """At the smallest size scores differ between documents: no threshold empties the vocabulary."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scores = toxicity.judge(docs, labels).select("score").distinct().count()
    assert scores > 1


def test_the_fit_is_the_least_penalised_loss():
    """Gradient steps against a search over a grid, for one feature and one pair."""
    x, y = np.array([[1.0], [1.0], [0.0], [0.0], [1.0], [0.0]]), np.array([1, 1, 0, 0, 0, 1.0])
    changes = np.array([[1.0]])

    def loss(w, b):
        score = x[:, 0] * w + b
        plain = np.logaddexp(0, score) - y * score
        weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
        return (weight * plain).sum() + 0.5 * toxicity.RIDGE * w * w + 0.3 * w * w

    weights, bias = toxicity.descend(x, y, changes, 0.3)
    best = min(((w, b) for w in np.linspace(-1, 1, 201) for b in np.linspace(-1, 1, 201)), key=lambda p: loss(*p))
    assert abs(weights[0] - best[0]) < 0.011 and abs(bias - best[1]) < 0.011


def test_repeated_rows_of_a_labelled_id_are_read_once(documents, spark):
    rows = [(i, f"good text {i}" if i % 2 else f"bad vermin {i}") for i in range(40)] + [(0, "bad vermin 0")] * 500
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    once = toxicity.fit(documents(rows[:40]), labels, F.lit(True))
    assert toxicity.fit(documents(rows), labels, F.lit(True)) == once
    assert quality.fit(documents(rows), labels, F.lit(True)) == quality.fit(documents(rows[:40]), labels, F.lit(True))


def test_awkward_rows(awkward, documents, spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame(
        [(None, 1, 1), (5, 1, 0), (5, 1, 0), (4, 0, 1), (4, 1, 1), (6, None, None), (77, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    for labels in (empty, odd):
        for judge in (quality.judge, toxicity.judge):
            rows = judge(awkward, labels).collect()
            assert len(rows) == 9
            assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
            assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert quality.judge(documents([]), odd).collect() == toxicity.judge(documents([]), odd).collect() == []
    kept = toxicity.without_toxic(awkward, empty)
    assert kept.columns == awkward.columns and kept.count() == 9


def test_labels_are_not_learned_from_held_out_rows(spark):
    rows = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    used = labelled.judged(rows, "toxic", labelled.remainder(5) != 0).collect()
    import zlib

    assert {r["doc_id"] for r in used} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5}
