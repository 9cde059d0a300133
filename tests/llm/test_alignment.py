"""Alignments of two vocabularies against a plain count over all overlapping tokens."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexistat.llm import alignment, tokens
from lexistat.llm.chunks import PIECE_BPE
from lexistat.llm.tokens import BYTE_BPE, byte_level_bytes

LETTERS = st.one_of(
    st.sampled_from("abstre'lvmdABS 019 \n\t\r.,\"!_-<|>'' ▁\xa0é"), st.characters(blacklist_categories=("Cs",))
)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def spans(ids, of):
    at, found = 0, []
    for i in ids:
        found.append((i, at, at + len(of(i))))
        at += len(of(i))
    return found


def brute(libraries, texts):
    """Rows as the contract states them, each link found by comparing byte ranges."""
    a_lib, b_lib = libraries
    entries = byte_level_bytes(a_lib.get_vocab())

    def piece(i):
        name = b_lib.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b_lib.is_byte(i) else name.replace("▁", " ").encode()

    each = []
    for text in texts:
        a = spans(a_lib.encode(" " + text, add_special_tokens=False).ids if text else [], entries.__getitem__)
        b = spans(b_lib.encode(text) if text else [], piece)
        wanted = (" " + (text or "")).encode()
        if b"".join(entries[i] for i, *_ in a) != wanted or b"".join(piece(i) for i, *_ in b) != wanted:
            a = b = []
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, begin = [], 0
        for end in ends:
            sides = [",".join(str(t[0]) for t in side if begin <= t[1] < end) for side in (a, b)]
            groups.append("|".join(sides))
            begin = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        each.append((len(a), len(b), len(groups), links, digest))
    count = Counter(link for row in each for link in row[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), d)
        for n_a, n_b, n_groups, links, d in each
    ]


TEXTS = [
    "It was the best of times,\nit was the worst of times", "naïve café — 東京 🙂 ok", "a\n\n\n b  c \n", " lead",
    "<|endoftext|> </s> <s> plain", "x▁y", "tab\there", "cr\r\nlf", "\xa0no break", "1234567890 3.14", "It was",
    "", None, " ", "\n", "hyper-parameter tokenization " * 400, "The The the", "<0x41> <unk>", "It was",
]


def found(rows):
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_alignment_is_that_of_all_overlaps(documents, libraries, sent):
    docs = documents(list(enumerate(TEXTS)))
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.cross_tokenizer(docs, sent_pairs=sent).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute(libraries, TEXTS)
    assert got[11] == (0, 0, 0, 0, 0, 0, "") and got[5][0] == 0


def ids_of(windows):
    """The ids on both sides, out of the written groups."""
    groups = [g.split("|") for w in windows for g in w[0].split(";")]
    return [[int(i) for g in groups for i in g[side].split(",")] for side in (0, 1)]


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.text(alphabet=LETTERS, max_size=30), min_size=1, max_size=3))
def test_words_give_the_ids_of_whole_texts(libraries, texts):
    a_lib, b_lib = libraries
    for text, windows in zip(texts, alignment._aligner(BYTE_BPE, PIECE_BPE).windows(texts), strict=True):
        if windows:
            assert ids_of(windows) == [a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)]


def test_anchors_cut_before_space_marked_tokens_of_both(libraries):
    """Windows of words are those that the tokens of the whole text show."""
    aligner = alignment.Aligner(BYTE_BPE, PIECE_BPE)
    text = "One two,three four\nfive six hyper-parameter 12 34."
    (by_word,) = aligner.windows([text])
    assert by_word == aligner._whole(text)
    for window in by_word:
        for ids, marked in zip(ids_of([window]), (aligner.marked_a, aligner.marked_b), strict=True):
            assert marked[ids[0]]
    known = len(aligner.by_word.young)
    [*aligner.windows([text, text + " two,three four\nfive"])]
    assert len(aligner.by_word.young) == known


def test_few_windows_and_pairs_are_kept(documents, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_WINDOWS", 3)
    monkeypatch.setattr(tokens, "LONG_TEXT", 40)
    aligner = alignment.Aligner(BYTE_BPE, PIECE_BPE)
    texts = [t or "" for t in TEXTS] + ["one two three " * 20 + "x\u2581y " + "one two " * 9]
    rows = brute(libraries, texts)
    for row, windows in zip(rows, aligner.windows(texts), strict=True):
        assert row[:3] == (*map(len, ids_of(windows)), sum(w[0].count("|") for w in windows))
    assert len(aligner.by_word.young) <= 3 + 70 and rows[-1][0] == 0


def test_pairs_are_added_in_bounded_parts(documents, libraries, monkeypatch):
    docs = documents(list(enumerate(TEXTS)))
    whole = sorted(map(tuple, alignment.pair_counts(alignment.texts_aligned(docs)).collect()))
    monkeypatch.setattr(alignment, "KEPT_PAIRS", 2)
    assert sorted(map(tuple, alignment.pair_counts(alignment.texts_aligned(docs)).collect())) == whole


def test_awkward_rows(documents, awkward, libraries):
    rows = awkward.collect()
    got = alignment.cross_tokenizer(awkward).collect()
    wanted = brute(libraries, [r["text"] if len(r["text"] or "") < 1000 else "" for r in rows])
    short = [tuple(r)[1:2] + tuple(r)[-1:] for r in got if r["doc_id"] != 4]
    assert sorted(short) == sorted((w[0], w[-1]) for w, r in zip(wanted, rows, strict=True) if r["doc_id"] != 4)
    (long,) = [r for r in got if r["doc_id"] == 4]
    assert long["n_a"] == 60_000 + 1 and long["n_links"] >= long["n_groups"] > 0
    assert alignment.cross_tokenizer(documents([])).collect() == []
