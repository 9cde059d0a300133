"""Sentencepiece vocabularies word by word, and the bytes that tokens stand for."""

from __future__ import annotations

import re
import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor

from lexistat.llm.tokens import cuts_of

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "\u2581"
# Characters that normal forms would compose or replace.
_PROBE = "e\u0301 \ufb01 \uff21 \u00bd  x"


class Pieces:
    """Ids of words and of texts, and the bytes of every id.

    The library puts a space before what it encodes, so a word is encoded with the space in front of it.
    """

    def __init__(self, path: str) -> None:
        self.library = SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        single = [self.library.is_byte(i) for i in range(size)]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if byte else name.replace(SPACE, " ").encode()
            for name, byte in zip(names, single, strict=True)
        ]
        self.marked = np.array([name[:1] == SPACE for name in names])
        normal = [name for name, byte in zip(names, single, strict=True) if not byte]
        # No token may hold the end of one word and the space before the next, and the library must leave
        # characters as they are.
        across = re.compile(f"[^{SPACE}]{SPACE}").search
        kept = b"".join([self.bytes[i] for i in self.library.encode(_PROBE)]) == f" {_PROBE}".encode()
        self.cuts = kept and not any(map(across, normal))
        self.sizes = np.array([*map(len, self.bytes)])

    def whole(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    def _gives_back(self, ids: list[int], text: str) -> bool:
        entries = self.bytes
        return b"".join([entries[i] for i in ids]) == text.encode()

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of words that are encoded as one text, a space before each, and where each word's end.

        None where the bytes of the ids are not those of the text.
        """
        if not words or not self.cuts:
            return None
        text = " ".join(words)
        (ids,) = self.whole([text])
        if not self._gives_back(ids, " " + text):
            return None
        found = np.array(ids, dtype="<u4")
        cuts = cuts_of(found, self.sizes, np.array([len(w.encode()) + 1 for w in words]))
        return None if cuts is None else (found, cuts)

    def words(self, words: list[str]) -> list[list[int] | None]:
        """Ids of each word; None where their bytes are not a space and the word."""
        return [
            ids if self.cuts and self._gives_back(ids, " " + word) else None
            for word, ids in zip(words, self.whole(words), strict=True)
        ]
