import random
import re

from lexistat.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places, labels = [], set()
    for label, phrase in licenses.PHRASES:
        wanted = phrase.split()
        for at in range(len(words)):
            if words[at : at + len(wanted)] == wanted:
                places.append(at)
                labels.add(label)
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(labels))


def test_phrases_equal_brute_force(documents):
    chance = random.Random(2)
    pool = "mit license License. apache General public GNU mit-license ÉÀ 7 \n the".split(" ")
    rows = [(i, " ".join(chance.choice(pool) for _ in range(chance.randrange(40)))) for i in range(80)]
    got = {
        r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        for r in licenses.scan(documents(rows)).collect()
    }
    assert got == {i: brute(text) for i, text in rows}


def test_edited_passage_gives_its_label(documents):
    bsd = dict(reversed(t) for t in licenses.PASSAGES)
    text = next(t for t, label in bsd.items() if label == "bsd").split()
    text[5:6] = ["all", "the"]  # an insertion shifts the diagonal
    rows = licenses.scan(documents([(1, "x " + " ".join(text)), (2, " ".join(text[:7]))])).collect()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["labels"] == "bsd" and licenses.COVERED <= found[1]["score"] < 1
    assert found[2]["labels"] == "" and found[2]["score"] == 0


def labelled(documents, *texts):
    rows = licenses.scan(documents(list(enumerate(texts)))).collect()
    return [(r["labels"], r["score"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_spans_are_bounded_and_in_order(documents):
    bsd = next(text for label, text in licenses.PASSAGES if label == "bsd").split()
    grams = [bsd[i : i + 3] for i in range(len(bsd) - 2)]
    drifting = " ".join(f"{' '.join(gram)} x{i}" for i, gram in enumerate(grams))
    found = labelled(
        documents, drifting, " ".join(bsd), " ".join([*bsd[:9], "odd", *bsd[9:]]),
        " ".join([*bsd[11:], *bsd[:11]]), " ".join(["one", *bsd, "two"] * 3),
    )
    assert found[0] == ("", 0) and found[1] == ("bsd", 1.0) and found[4] == ("bsd", 1.0)
    assert found[2][0] == "bsd" and found[2][1] == len(bsd) / (len(bsd) + 1)
    assert found[3] == ("", 0)


def test_whole_texts_longer_than_one_vote(documents):
    """All words of a long template count, beyond any number of bits."""
    for label, text in licenses.TEXTS:
        words = text.split()
        half = len(words) // 2
        # The first half alone holds a passage of its own, the second half half of the text.
        found = labelled(documents, text, " ".join(words[half:]), " ".join([*words[:half], "an", "edit", *words[half:]]))
        assert found[0] == (label, 1.0)
        assert found[1] == ("", 0)
        assert found[2][0] == label and found[2][1] > 0.95
    assert max(row[4] for row in licenses.templates()) > 2 * licenses.BITS


def test_hits_at_the_border_of_two_votes(documents):
    """The words of a hit are counted across the border between two parts of a vote."""
    _, text = licenses.TEXTS[0]
    words, held = text.split(), 0.7
    for begin in range(0, len(words) - int(held * len(words)), 7):
        some = words[begin : begin + int(held * len(words))]
        rows = licenses.spans(licenses.hits(documents([(1, " ".join(some))]))).collect()
        full = next(i for i, row in enumerate(licenses.templates()) if row[3] == len(words))
        number = licenses.templates()[full][0]
        (span,) = [r for r in rows if r["template"] == number]
        assert abs(span["coverage"] - len(some) / len(words)) < 1e-9 and span["start"] == 0
        break


def test_awkward_rows(awkward, documents):
    rows = licenses.scan(awkward).collect()
    assert len(rows) == 9
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[4][0]["n_base"] == 30_000 and by[4][0]["last_word"] == 59_998
    assert [r["n_words"] for r in by[5]].count(4) == 2
    assert by[1][0]["n_words"] == by[None][0]["n_words"] == 0 and by[1][0]["first_word"] is None
    assert licenses.scan(documents([])).collect() == []
