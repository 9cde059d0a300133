import json
import random
import zlib
from array import array
from collections import defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexistat.llm import ans, binary, packing, tokens
from lexistat.session import shared_folder

LETTERS = st.one_of(
    st.sampled_from("abstre'lvmdABS 019 \n\t.,\"!_-<|>'' "), st.characters(blacklist_categories=("Cs",))
)
KINDS = [(tokens.BYTE_BPE, True), (tokens.WORD_BPE, False)]


def ids(path, keeps_space, text):
    library = tokens.encoder(path, keeps_space).library
    return array("I", [*library.encode(text or "", add_special_tokens=False).ids, tokens.END])


@pytest.mark.parametrize("kind", KINDS)
def test_pieces_give_the_ids_of_whole_texts(kind):
    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=LETTERS, max_size=40))
    def equal(text):
        (found,) = tokens.encoder(*kind).encode([text])
        assert found == ids(*kind, text)[:-1].tobytes()

    equal()


@pytest.mark.parametrize("kind", KINDS)
def test_small_generations_and_long_texts(kind, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)
    monkeypatch.setattr(tokens, "KEPT_BARE", 50)
    monkeypatch.setattr(tokens, "LONG_TEXT", 300)
    monkeypatch.setattr(tokens, "BATCH_CHARS", 500)
    chance = random.Random(1)
    texts = [" ".join(f"{chance.choice('abc')}x{chance.randrange(99)}," for _ in range(n)) for n in (5, 40, 300, 0)]
    encoder = tokens.Encoder(*kind)
    assert list(encoder.encode([*texts, None])) == [ids(*kind, t)[:-1].tobytes() for t in [*texts, None]]


def test_packing_is_whole_and_gapless(documents):
    chance = random.Random(3)
    rows = [(i, " ".join(f"w{chance.randrange(999)}" for _ in range(chance.randrange(900)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "a " * 5000), (502, "a " * 5000)]
    got = packing.pack(documents(rows), per_part=40).collect()
    texts = dict(rows)
    held = defaultdict(list)
    for r in got:
        whole = ids(*KINDS[0], texts[r["doc_id"]])
        piece = whole[r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r["ids_crc32"]
        assert r["piece"] == 0 or r["length"] == 1024
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert total == sum(len(ids(*KINDS[0], t)) for _, t in rows)
    assert len(held) <= 1.1 * total / 1024 + 4
    assert packing.pack(documents([])).collect() == []


def test_the_bound_of_open_sequences_is_reached(spark):
    """On the pieces of a table, sequences close before they are full, and yet little is left free."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lengths = [r["length"] for r in packing.pieces(docs).filter("length < 1024").orderBy("ids_crc32").collect()]
    sequences = packing.OpenSequences(packing.SEQUENCE, packing.OPEN)
    for n in lengths:
        sequences.place(n)
    assert sequences.closed > 0
    row = packing.filled(packing.pack(docs)).first()
    assert 0.9 < row["fill"] <= 1


@pytest.mark.parametrize("kind", KINDS)
def test_every_character_below_the_astral_planes(kind):
    """Alone, between letters and before a mark, as the library has it."""
    letters = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    encoder = tokens.encoder(*kind)
    texts = [t for c in letters for t in (f"a{c}b {c}", f"x {c}. y{c}, {c}{c}\n{c}")]
    found = encoder.library.encode_batch_fast(texts, add_special_tokens=False)
    assert [*encoder.encode(texts)] == [array("I", x.ids).tobytes() for x in found]


def test_an_unknown_vocabulary_is_not_cut(tmp_path):
    """Where the file does not say how words are cut, the library gets whole texts."""
    file = json.loads(Path(tokens.BYTE_BPE).read_text())
    file["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(file))
    encoder = tokens.Encoder(str(path), True)
    texts = ["one two  three", "a b, c", ""]
    assert not encoder.cuts
    assert [*encoder.encode(texts)] == [ids(str(path), True, t)[:-1].tobytes() for t in texts]


def test_the_fullest_sequence_closes_first():
    sequences = packing.OpenSequences(10, 2)
    assert [sequences.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # 7 closes for 8
    assert sequences.place(3) == (0, 6)
    assert sequences.place(1) == (0, 9) and sequences.place(2) == (2, 8)


@pytest.mark.parametrize("size", [1, 511, 512, 513, 131_073, 262_145])
def test_segments_round_trip(size):
    import numpy as np

    numbers = (np.random.default_rng(size).zipf(1.2, size) % 49_408).astype(np.uint32)
    directory, blocks = ans.decode_segment(ans.encode_segment(numbers, b"names"))
    assert directory == b"names" and (np.concatenate([*blocks]) == numbers).all()


def test_checkpoints_and_checksums():
    import numpy as np

    numbers = (np.random.default_rng(0).zipf(1.3, ans.BLOCK) % 1000).astype(np.uint32)
    table = ans.Table.fitted(numbers)
    block = ans.encode_block(numbers, table)
    half = ans.decode_block(block, table, table.slots(), 1)
    assert (half == numbers[ans.STRIDE :]).all()
    assert (ans.decode_block(block, table, table.slots(), 0, 1) == numbers[: ans.STRIDE]).all()
    spoilt = bytearray(block)
    spoilt[-5] ^= 1
    with pytest.raises(ValueError):
        ans.decode_block(bytes(spoilt), table, table.slots())
    a, b = b"some bytes", b"and many more" * 99
    assert ans.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_files_round_trip(spark, awkward, documents):
    folder = f"{shared_folder(spark)}/token-test"
    binary.write(awkward, folder, parts=3)
    got = binary.read(spark, folder).orderBy("start").collect()
    rows = awkward.select("doc_id", "text").collect()
    wanted = sorted(
        ((r["doc_id"] is not None, r["doc_id"] or 0, zlib.crc32(ids(*KINDS[1], r["text"]).tobytes())) for r in rows)
    )
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids_crc32"]) for r in got) == wanted
    names = [r["doc_id"] or 0 for r in got]
    assert names == sorted(names)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    binary.write(documents([]), folder, parts=2)
    assert binary.read(spark, folder).collect() == []


def test_documents_longer_than_a_segment():
    """Fragments of one document, cut by the writer, join to its checksum."""
    writer = binary._Writer()
    size, binary.ans.SEGMENT = binary.ans.SEGMENT, 1000
    try:
        long = array("I", range(2500)).tobytes()
        out = [*writer.add(7, array("I", [5]).tobytes()), *writer.add(8, long), *writer.rest()]
    finally:
        binary.ans.SEGMENT = size
    assert [row[2] for row in out] == [1, 1000, 1000, 500]
    check = 0
    for row in out[1:]:
        _, blocks = ans.decode_segment(row[3])
        data = b"".join(b.astype("<u4").tobytes() for b in blocks)
        check = ans.crc32_joined(check, zlib.crc32(data), len(data))
    assert check == zlib.crc32(long)
