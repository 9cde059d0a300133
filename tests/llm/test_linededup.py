import random
import re
from collections import defaultdict

from lexistat.llm import linededup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, least):
    """Every longest match of a place with one before it, if it holds enough words."""
    seen, gone = defaultdict(list), defaultdict(set)
    for doc, text in sorted(rows):
        own = [line.strip(" \t\r\x0b\x0c") for line in (text or "").split("\n")]
        own = [line for line in own if line]
        for p in range(len(own)):
            for other, q in seen[own[p]]:
                n = 0
                while p + n < len(own) and q + n < len(other) and own[p + n] == other[q + n]:
                    n += 1
                if sum(len(WORD.findall(x)) for x in own[p : p + n]) >= least:
                    gone[doc].update(range(p, p + n))
            seen[own[p]].append((own, p))
    return {doc: len(gone[doc]) for doc, _ in rows}


def test_equals_brute_force(documents):
    chance = random.Random(8)
    pool = ["a", "b c", "d e f", "g", "", "  ", "h i j k l", "m n\tm m"]
    rows = []
    for i in range(50):
        lines = [chance.choice(pool) for _ in range(chance.randrange(30))]
        if rows and chance.random() < 0.4:
            lines = chance.choice(rows)[1].split("\n")
            lines[chance.randrange(len(lines))] = chance.choice(pool)
        rows.append((i, "\n".join(lines)))
    got = {r["row"]["doc_id"]: r["n_removed"] for r in linededup.cleaned(documents(rows), 8).collect()}
    assert got == brute(rows, 8)


def test_first_copy_stays_and_short_runs_too(documents):
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(20)) for i in range(3))
    rows = [
        (1, f"top one\n{passage}\nend one"), (2, f"top two\n{passage}\n\nend two"), (3, "top one\nend two"),
        (4, passage), (5, "fine"),
    ]
    docs = documents(rows)
    out = {r["doc_id"]: r for r in linededup.without_repeats(docs).collect()}
    assert out[1]["text"] == rows[0][1] and out[2]["text"] == "top two\nend two"
    assert out[3]["text"] == rows[2][1] and 4 not in out and out[5]["text"] == "fine"
    assert out[2]["n_chars"] == len("top two\nend two") and out[2]["_row"] == "own"
    assert linededup.without_repeats(docs).columns == docs.columns


def test_awkward_rows(awkward, documents):
    rows = linededup.cleaned(awkward, 2).collect()
    assert len(rows) == 9
    by = defaultdict(list)
    for r in rows:
        by[r["row"]["doc_id"]].append((r["n_lines"], r["n_removed"], r["text"]))
    assert by[1] == [(0, 0, None)] and by[2] == [(0, 0, "")] and by[3] == [(0, 0, " \n\t ")]
    # Equal rows are one text; the same text under another id is a later copy.
    assert by[5].count((1, 0, "one line of text")) == 2 and by[6] == [(1, 1, "")]
    assert linededup.cleaned(documents([])).collect() == []
