"""Token counts against the library, and what the cache saves."""

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lexistat.llm import chunks, tokencounts, tokens
from lexistat.llm.tokens import BYTE_BPE
from lexistat.session import shared_folder

LETTERS = st.one_of(
    st.sampled_from("abstre'lvmdABS 019 \n\t\r.,\"!_-<|>'' ▁\xa0"), st.characters(blacklist_categories=("Cs",))
)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=chunks.PIECE_BPE)


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.text(alphabet=LETTERS, max_size=40), max_size=4))
def test_counts_are_the_librarys(texts):
    assert tokencounts.counts(texts) == [len(ids) for ids in LIBRARY.encode(texts)]


def test_every_character_counts_as_in_the_library():
    letters = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [t for c in letters for t in (c, f"a{c}b", f"a {c} b", f"{c}.\n{c}")]
    assert tokencounts.counts(texts) == [len(ids) for ids in LIBRARY.encode(texts)]


def test_small_generations_and_long_texts(monkeypatch):
    monkeypatch.setattr(tokens, "LONG_TEXT", 20)
    texts = ["one two three four five six " * 5, "one seven two\neight", "", "nine ten one two  three\u2581 " * 4] * 2
    pieces, _ = tokencounts._piece_counter(chunks.PIECE_BPE)
    seen = tokens.Seen(lambda some: [None if ids is None else len(ids) for ids in pieces.words(some)], 3)
    monkeypatch.setattr(tokencounts, "_piece_counter", lambda path: (pieces, seen))
    assert tokencounts.counts(texts) == [len(ids) for ids in LIBRARY.encode(texts)]


def expected(rows, limit=4096):
    out = []
    for r in rows:
        text = r["text"] or ""
        n = len(LIBRARY.encode(text))
        out.append((r["doc_id"], len(text.encode()), n, n > limit))
    return sorted(out, key=repr)


def test_awkward_rows_and_what_is_encoded(spark, awkward, documents, tmp_path):
    folder = f"{shared_folder(spark)}/counts-{tmp_path.name}"
    got = tokencounts.count_tokens(awkward, folder)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(awkward.collect())
    name = tokencounts.tokenizer_digest(chunks.PIECE_BPE)

    def entries():
        return spark.read.parquet(folder).count()

    # Null and empty texts are one, and so are the three rows of one line.
    assert entries() == len({r["text"] or "" for r in awkward.collect()})
    before = entries()
    more = documents([(9, "one line of text"), (10, "a new text"), (11, "a new text"), (None, "a new text")])
    assert sorted(map(tuple, tokencounts.count_tokens(more, folder).collect()), key=repr) == expected(more.collect())
    assert entries() == before + 1
    # Another vocabulary has its own entries.
    other = tokencounts.count_tokens(more, folder, path=BYTE_BPE).collect()
    assert len(other) == 4 and entries() == before + 3
    # An entry that two runs appended counts once.
    stored = spark.read.schema(tokencounts.CACHE).parquet(folder)
    stored.filter(stored.tokenizer == name).write.mode("append").partitionBy("tokenizer").parquet(folder)
    assert tokencounts.count_tokens(more, folder).count() == 4
    assert tokencounts.count_tokens(documents([]), folder).collect() == []


def test_stored_counts_are_used(spark, documents, tmp_path):
    """A count in the cache is taken as it stands: nothing known is encoded again."""
    folder = f"{shared_folder(spark)}/known-{tmp_path.name}"
    docs = documents([(1, "known text"), (2, "unknown text")])
    known = docs.filter("doc_id = 1").select(
        tokencounts.text_digest(docs.text).alias("digest"), (docs.doc_id * 999).alias("n_tokens")
    )
    name = tokencounts.tokenizer_digest(chunks.PIECE_BPE)
    known.selectExpr("*", f"'{name}' AS tokenizer").write.partitionBy("tokenizer").parquet(folder)
    got = {r["doc_id"]: r["n_tokens"] for r in tokencounts.count_tokens(docs, folder).collect()}
    assert got == {1: 999, 2: len(LIBRARY.encode("unknown text"))}


def test_many_missing_texts_drop_copies_before_they_are_chosen(spark, documents, tmp_path):
    folder = f"{shared_folder(spark)}/many-{tmp_path.name}"
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    docs = documents([(i, f"text {i % 7}") for i in range(50)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = tokencounts.count_tokens(docs, folder).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(map(tuple, got), key=repr) == expected(docs.collect())
    assert spark.read.parquet(folder).count() == 7
