from collections import defaultdict

from lexistat.llm import mixing


def levels(sizes, weights=mixing.WEIGHTS, most=mixing.MOST_COPIES):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        shares = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if shares[s] > most * sizes[s]]
        if not over:
            return stopped | shares
        stopped |= {s: most * sizes[s] for s in over}


def test_targets_and_words_taken(documents):
    rows = [
        (i, "w " * (1 + i * 7 % 50), source)
        for i, source in enumerate(["a"] * 20 + ["b"] * 300 + ["c"] * 5 + [None] * 70 + ["d"] * 9)
    ]
    got = mixing.mix(documents(rows)).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    wanted = levels(sizes)
    for source in sizes:
        assert abs(target[source] - wanted[source]) < 1e-6
        assert abs(taken[source] - target[source]) <= 2 * 50


def test_documents_as_often_as_taken(documents):
    rows = [(i, f"t{i} " * (i % 9), "ab"[i % 2]) for i in range(50)]
    docs = documents(rows + rows[:10])
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    wanted, have = defaultdict(int), defaultdict(int)
    for r in mixing.mix(docs).collect():
        wanted[r["doc_id"]] += r["copies"]
    for r in out.collect():
        have[r["doc_id"]] += 1
        assert r["_row"] == "own"
    assert {k: v for k, v in wanted.items() if v} == have


def test_awkward_rows(awkward, documents):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == 9 and {r["size"] for r in rows if r["doc_id"] in (None, 1, 2, 3)} == {0}
    assert sorted(map(repr, mixing.mixed_documents(awkward).collect())) == sorted(
        map(repr, mixing.mixed_documents(awkward).collect())
    )
    assert mixing.mix(documents([])).collect() == []
    assert mixing.mixed_documents(documents([(1, None), (2, "")])).count() >= 0
