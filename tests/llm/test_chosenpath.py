import random
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from lexistat.llm import chosenpath
from lexistat.llm import components as graph
from lexistat.llm.components import components


def brute(rows, size, percent):
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets[doc] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    label = {doc: doc for doc in sets}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    holders = defaultdict(list)
    for doc in sorted(sets):
        for other, both in Counter(o for s in sets[doc] for o in holders[s]).items():
            if 100 * both >= percent * (len(sets[doc]) + len(sets[other]) - both):
                a, b = sorted((top(doc), top(other)))
                label[b] = a
        for s in sets[doc]:
            holders[s].append(doc)
    return {doc: (len(sets[doc]), top(doc)) for doc in sets}


def star(chance, copies):
    """Copies of one text with some words changed, often linked by way of the text alone."""
    pool = [f"w{i}" for i in range(2000)]
    text = [chance.choice(pool) for _ in range(150)]
    rows = []
    for i in range(copies):
        own = list(text)
        for _ in range(chance.randrange(7)):
            own[chance.randrange(len(own))] = chance.choice(pool)
        rows.append((3 * i, " ".join(own)))
    rows += [(5000 + i, " ".join(chance.choice(pool[:40]) for _ in range(chance.randrange(9)))) for i in range(80)]
    return rows + [(9000 + i, chance.choice(rows)[1].upper()) for i in range(30)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(documents, monkeypatch, small):
    if small:  # nodes branch to the last level, and blocks are verified node by node
        monkeypatch.setattr(chosenpath, "SMALL_NODE", 40)
        monkeypatch.setattr(chosenpath, "BLOCK_DOCS", 30)
    rows = star(random.Random(6), 150)
    got = chosenpath.linked(documents(rows), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 3, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_components(spark):
    edges = spark.createDataFrame([(9, 8), (8, 7), (7, 3), (3, 3), (20, 21), (22, 21), (4, 4)], "a long, b long")
    got = {r["id"]: r["label"] for r in components(edges).collect()}
    assert got == {9: 3, 8: 3, 7: 3, 3: 3, 20: 20, 21: 20, 22: 20}


def test_awkward_rows(awkward, documents):
    rows = chosenpath.linked(awkward, 3, 85).collect()
    assert len(rows) == 9
    empty = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert all(r["n_shingles"] == 0 and r["component_id"] == r["doc_id"] for r in empty)
    assert {(r["component_id"], r["kept"]) for r in rows if r["doc_id"] == 6} == {(5, False)}
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)]
    kept = chosenpath.one_of_each(awkward)
    assert kept.columns == awkward.columns and 6 not in {r["doc_id"] for r in kept.collect()}
    assert chosenpath.linked(documents([])).collect() == []


@pytest.mark.parametrize("shape", ["ascending", "alternating", "star"])
def test_components_in_few_rounds(spark, monkeypatch, shape):
    """A path of 10,000 edges, and shapes of few minima or many, in at most 20 written rounds of pointers."""
    n, ids = 10_000, F.col("id")
    far = {"ascending": ids + 1, "alternating": F.lit(2 * n) - ids, "star": F.lit(3 * n)}[shape]
    near = {"ascending": ids, "alternating": ids, "star": ids}[shape]
    edges = spark.range(n).select(near.alias("a"), far.alias("b"))
    if shape == "alternating":
        edges = edges.union(spark.range(n - 1).select((ids + 1).alias("a"), (F.lit(2 * n) - ids).alias("b")))
    names, written = [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, name: (names.append(name), written(df, name))[1])
    labels = graph.components(edges)
    assert labels.agg(F.max("label"), F.count("*")).first()[0] == 0
    assert names.count("roots") <= 20 and names.count("nearest") <= 3
