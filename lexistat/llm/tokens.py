"""Token ids of whole texts in Python workers.

The tokenizers library gives all ids. No token reaches over white space into the next word, so a text is the
sequence of its words, and a word has the same ids in every text. What words give is kept by the worker, a
bounded number of them for as long as it lives; new ones are encoded by the library in batches. A text, or a
vocabulary, that cannot be cut safely goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
from tiktoken import Encoding  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END = 2

KEPT_PIECES = 250_000  # in each of two generations
KEPT_BARE = 700_000  # where words are kept without their spaces, nothing else is held by the worker
LONG_TEXT = 1 << 20  # characters cut at once
BATCH_CHARS = 1 << 20

# White space other than space and line end, in any library's tables, and what may begin a special token:
# texts with them are encoded whole. The null character marks a word without a space before it.
_CONTROLS = "\x00\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_unusual = re.compile(
    r"[\x00\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f-\u2064\u3000\ufeff]|<\|"
).search
_single_space = re.compile(r"(?<=[^ \n]) (?=[^ \n])")
BARE = "\x00"


def regular(text: str) -> bool:
    """True where only spaces and line ends are white space, in whatever library."""
    if text.isascii():
        return "<|" not in text and not any(c in text for c in _CONTROLS)
    return not _unusual(text)


def spaced(text: str) -> list[str] | None:
    """The parts between single spaces that stand between other characters; None if it cannot be cut."""
    if not regular(text):
        return None
    if "  " in text or " \n" in text or "\n " in text or text[:1] in " \n" or text[-1:] in " \n":
        return _single_space.split(text)
    return text.split(" ")


def portions(text: str) -> Iterator[str]:
    """A text, or a very long one in parts that single spaces between words part."""
    begin = 0
    while len(text) - begin > LONG_TEXT:
        place = _single_space.search(text, begin + LONG_TEXT)
        if not place:
            break
        yield text[begin : place.start()]
        begin = place.end()
    yield text[begin:] if begin else text


def batches(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in lists of about BATCH_CHARS characters."""
    some: list[str] = []
    size = 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= BATCH_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


class Seen[T]:
    """What ``learn`` gives for words, kept in two generations of bounded size.

    ``learn`` returns None for a word whose value cannot be trusted outside its text.
    """

    def __init__(self, learn: Callable[[list[str]], Iterable[T | None]], kept: int | None = None) -> None:
        self.learn = learn
        self.kept = kept or KEPT_PIECES
        self.young: dict[str, T | None] = {}
        self.old: dict[str, T | None] = {}
        self.untrusted: set[str] = set()  # of the young generation

    def _need(self, words: set[str]) -> None:
        """Have all ``words`` in the young generation; a full one becomes the old one."""
        young, old = self.young, self.old
        missing = [w for w in words if w not in young]
        if len(young) + len(missing) > self.kept:
            self.old, self.young, missing = young, {}, [*words]
            young, old = self.young, self.old
            self.untrusted = set()
        carried = {w: old[w] for w in missing if w in old}
        young.update(carried)
        self.untrusted.update(w for w, value in carried.items() if value is None)
        fresh = [w for w in missing if w not in young]
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            for word, value in zip(some, self.learn(some), strict=True):
                young[word] = value
                if value is None:
                    self.untrusted.add(word)

    def values(self, cuts: list[list[str] | None]) -> Iterator[list[T] | None]:
        """The values of every text's words in order; None for a text that must stay whole."""
        needed = set().union(*[c for c in cuts if c is not None])
        # More words than a generation holds can only come from few texts; they are done one by one.
        if len(needed) > self.kept and len(cuts) > 1:
            half = len(cuts) // 2
            yield from self.values(cuts[:half])
            yield from self.values(cuts[half:])
            return
        self._need(needed)
        get = self.young.__getitem__
        for words in cuts:
            yield None if words is None or not self.untrusted.isdisjoint(words) else [*map(get, words)]


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in the vocabularies: itself where it is printable, and the
    next one from 256 on where not."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


# Characters on whose class and case all libraries agree and that never compose: visible ASCII, Latin letters
# but for the dotted capital I, and general punctuation. Words of these may be encoded together.
_agreed = re.compile(
    r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u2010-\u2027]+"
).fullmatch
# Letters and digits are tokens apart from the marks around them, but for an apostrophe before a word,
# which may be part of it.
_word = r"[^\W_]+(?:'[^\W_]+)*"
_parts = re.compile(rf"'?{_word}|(?:[^\w\s]|_)+").findall
# A comma or full stop behind what is no letter or digit that all libraries agree on.
_mark_before = re.compile(r"[^A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f][,.] ").search
_letters = _byte_letters()


def joinable(word: str) -> bool:
    """True where a word can stand between single spaces without being cut differently."""
    return word[:1] not in " \n\x00" and word[-1:] not in " \n"


def cuts_of(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
    """Where the ids of joined words end, for the bytes of every id and of every word.

    None where tokens do not end with the words.
    """
    ends, wanted = sizes[ids].cumsum(), lengths.cumsum()
    if not len(ends) or ends[-1] != wanted[-1]:
        return None
    at = np.searchsorted(ends, wanted)
    return at + 1 if (ends[at] == wanted).all() else None


def byte_level_bytes(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes that each entry of a byte-level vocabulary stands for, by id."""
    back = {chr(letter): byte for byte, letter in _letters.items()}
    entries = [b""] * (max(vocabulary.values()) + 1)
    for name, number in vocabulary.items():
        entries[number] = bytes([back[c] for c in name]) if all(c in back for c in name) else name.encode()
    return entries


class Joined:
    """Words in a byte-level vocabulary, many of them encoded as one text.

    Where the file's merges come in the order of their ids, the ids are the ranks that another
    public library of byte pairs wants, which takes a third of the time for them.
    """

    def __init__(self, file: dict, entries: list[bytes]) -> None:
        model = file["model"]
        merged = [pair.replace(" ", "") if isinstance(pair, str) else "".join(pair) for pair in model["merges"]]
        places = [model["vocab"][name] for name in merged]
        special = {entry["id"] for entry in file["added_tokens"]}
        self.ranked: Encoding | None = None
        self.sizes = np.array([*map(len, entries)])
        if places == sorted(places) and not special.intersection(places):
            ranks = {entry: i for i, entry in enumerate(entries) if i not in special}
            self.ranked = Encoding(
                "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of words with a space before each, and where each word's end."""
        if self.ranked is None or not words:
            return None
        ids = np.array(self.ranked.encode_ordinary(" " + " ".join(words)), dtype="<u4")
        cuts = cuts_of(ids, self.sizes, np.array([len(w.encode()) + 1 for w in words]))
        return None if cuts is None else (ids, cuts)


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, keeps_space: bool) -> None:
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.keeps_space = keeps_space
        file = json.loads(Path(path).read_text())
        self.cuts = self._known(file)
        self.joined = Joined(file, byte_level_bytes(self.library.get_vocab())) if keeps_space and self.cuts else None
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[number for name, number in vocabulary.items() if name.endswith("</w>")]] = True
        self.seen = Seen(self._learn, KEPT_PIECES if keeps_space else KEPT_BARE)

    def _known(self, file: dict) -> bool:
        """Whether the vocabulary is cut at white space in the way that ``keeps_space`` says."""
        before = file["pre_tokenizer"] or {}
        if self.keeps_space:
            kept = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            return bool(kept and not file["normalizer"])
        steps = [step["type"] for step in (file["normalizer"] or {}).get("normalizers", [])]
        return bool(file["model"].get("end_of_word_suffix")) and steps == ["NFC", "Replace", "Lowercase"]

    def _library_ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _learn(self, words: list[str]) -> Iterable[bytes]:
        agreed = [w for w in words if _agreed(w)]
        known = self._with_space(agreed) if self.keeps_space else self._without_case(agreed)
        rest = [w for w in words if w not in known]
        if self.keeps_space:
            texts = [w[1:] if w[:1] == BARE else " " + w for w in rest]
        else:
            texts = rest
        known.update(zip(rest, self._library_ids(texts), strict=True))
        return map(known.__getitem__, words)

    def _with_space(self, words: list[str]) -> dict[str, bytes]:
        found = self.joined.encode(words)
        if found is None:
            return {}
        data, ends = found[0].tobytes(), (4 * found[1]).tolist()
        return {w: data[begin:end] for w, begin, end in zip(words, [0, *ends], ends, strict=False)}

    def _letters_alone(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters, encoded as one text: each ends where an entry for an end of word comes."""
        if not words:
            return {}
        data = self._library_ids([" ".join(words)])[0]
        ends = (4 * (np.flatnonzero(self.ends_word[np.frombuffer(data, "<u4")]) + 1)).tolist()
        if len(ends) != len(words):
            return {}
        return {w: data[begin:end] for w, begin, end in zip(words, [0, *ends], ends, strict=False)}

    def _without_case(self, words: list[str]) -> dict[str, bytes]:
        """Letters alone are one token to be: the vocabulary's model has nothing to compose or cut."""
        known = self._letters_alone([w for w in words if w.isalpha()])
        tokenize, words = self.model.tokenize, [w for w in words if w not in known]
        marks = {part for word in words for part in _parts(word) if not part.isalpha()}
        ids = dict(zip(marks, self._library_ids([*marks]), strict=True))
        for word in words:
            found = []
            for part in _parts(word.lower()):
                if part.isalpha():
                    letters = part.encode().decode("latin-1").translate(_letters)
                    found.append(array("I", [t.id for t in tokenize(letters)]).tobytes())
                else:
                    found.append(ids.get(part) or self._library_ids([part])[0])
            known[word] = b"".join(found)
        return known

    def _cut(self, text: str, begins: bool) -> list[str] | None:
        if not self.cuts:
            return None
        if self.keeps_space:
            words = spaced(text)
            return [BARE + words[0], *words[1:]] if words and begins else words
        if not regular(text):
            return None
        # A comma or full stop behind a letter is a token of its own, with a space before it or not.
        if not _mark_before(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        # The vocabulary has no case; that of ASCII is the same in every library.
        return (text.lower() if text.isascii() else text).split()

    def _some(self, texts: list[str], begins: bool = True) -> Iterator[bytes]:
        cuts = [self._cut(text, begins) for text in texts]
        for text, found in zip(texts, self.seen.values(cuts), strict=True):
            if found is not None:
                yield b"".join(found)
            else:
                space = " " if self.keeps_space and not begins else ""
                yield self._library_ids([space + text])[0]

    def _long(self, text: str) -> bytes:
        parts = portions(text)
        first = b"".join(self._some([next(parts)]))
        return first + b"".join(ids for part in parts for ids in self._some([part], begins=False))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of every text, in order; none for a null or empty text."""
        for some in batches(text or "" for text in texts):
            # The last text alone may be very long.
            if len(some[-1]) <= LONG_TEXT:
                yield from self._some(some)
                continue
            if len(some) > 1:
                yield from self._some(some[:-1])
            yield self._long(some[-1])


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker's own encoder for a vocabulary file."""
    key = (path, keeps_space)
    if key not in _encoders:
        _encoders[key] = Encoder(path, keeps_space)
    return _encoders[key]
