"""A file format for token ids: static range asymmetric numeral systems.

A segment is one row of a Parquet table, so that Spark commits it whole and any task can decode
it alone. It holds one frequency table, shared by all its blocks, a directory of documents, and the
blocks. A block codes its tokens in ``LANES`` interleaved streams with one state each: token i
belongs to step ``i // LANES`` of lane ``i % LANES``, and one step of all lanes is a few array operations. Encoding
runs from the last step to the first, decoding from the first to the last. At every ``STRIDE``
tokens a checkpoint keeps the states and the place in the word stream, so parts of a block can be
decoded on their own; each block and each segment's tokens carry a crc32.

    segment    magic, number of tokens and of blocks, then length-prefixed: table, directory, blocks
    table      symbols (ascending) and their frequencies, which sum to 2**SCALE; deflated
    block      tokens, words, crc32 of the tokens, checkpoints (place, one state per lane), words

All numbers are little-endian. States stay in [2**31, 2**63) and pass 32-bit words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MAGIC = b"RANS\x01"
SCALE = 20
LANES = 512
BLOCK = 1 << 18
STRIDE = 1 << 17
SEGMENT = 1 << 22
MOST_IDS = 1 << 24

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE)
_MASK = np.uint64((1 << SCALE) - 1)
_LEAST = np.uint64(0xFFFFFFFF)
_EMIT = np.uint64(31 - SCALE + 32)


@dataclass(frozen=True)
class Table:
    """Symbols in ascending order, their frequencies and what lies before each."""

    symbols: np.ndarray
    frequencies: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray, frequencies: np.ndarray) -> Table:
        frequencies = frequencies.astype(np.uint64)
        return cls(symbols.astype(np.uint32), frequencies, np.cumsum(frequencies) - frequencies)

    @classmethod
    def fitted(cls, tokens: np.ndarray) -> Table:
        """Every symbol gets one part of 2**SCALE and its share of the rest; the commonest what is left."""
        if tokens.max() >= MOST_IDS:
            raise ValueError(f"token ids stay below {MOST_IDS}")
        counts = np.bincount(tokens)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
        spare = (1 << SCALE) - len(symbols)
        if spare < 0:
            raise ValueError(f"more than 2**{SCALE} distinct tokens in a segment")
        frequencies = 1 + counts * spare // counts.sum()
        frequencies[counts.argmax()] += (1 << SCALE) - frequencies.sum()
        return cls.of(symbols, frequencies)

    def packed(self) -> bytes:
        steps = np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4").tobytes()
        return zlib.compress(steps + self.frequencies.astype("<u4").tobytes())

    @classmethod
    def unpacked(cls, data: bytes) -> Table:
        numbers = np.frombuffer(zlib.decompress(data), dtype="<u4")
        half = len(numbers) // 2
        return cls.of(np.cumsum(numbers[:half], dtype=np.uint32), numbers[half:])

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """The place among ``symbols`` of every token."""
        place = np.zeros(int(self.symbols[-1]) + 1, dtype=np.int32)
        place[self.symbols] = np.arange(len(self.symbols), dtype=np.int32)
        return place[tokens]

    def slots(self) -> np.ndarray:
        """The place among ``symbols`` of every slot."""
        return np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.frequencies.astype(np.int64))


def encode_block(tokens: np.ndarray, table: Table) -> bytes:
    places = table.places(tokens)
    frequency, before = table.frequencies[places], table.before[places]
    states = np.full(LANES, _LOW, dtype=np.uint64)
    steps = -(-len(tokens) // LANES)
    stride = STRIDE // LANES
    words: list[np.ndarray] = []
    count = 0
    marks: list[tuple[int, bytes]] = []
    for step in range(steps - 1, -1, -1):
        here = slice(step * LANES, min((step + 1) * LANES, len(tokens)))
        f = frequency[here]
        x = states[: len(f)]
        full = x >= (f << _EMIT)
        if full.any():
            words.append((x[full] & _LEAST).astype("<u4"))
            count += len(words[-1])
            x[full] >>= _WORD
        share = x // f
        states[: len(f)] = (share << _SCALE) + (x - share * f) + before[here]
        if step % stride == 0:
            marks.append((count, states.astype("<u8").tobytes()))
    stream = np.concatenate(words[::-1]).tobytes() if words else b""
    head = struct.pack("<IIIH", len(tokens), count, zlib.crc32(tokens.astype("<u4").tobytes()), len(marks))
    points = b"".join(struct.pack("<I", count - n) + state for n, state in reversed(marks))
    return head + points + stream


_HEAD = struct.calcsize("<IIIH")
_POINT = 4 + 8 * LANES


def decode_block(data: bytes, table: Table, slots: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The tokens from checkpoint ``first`` up to checkpoint ``last`` (None: the end of the block)."""
    total, count, check, marks = struct.unpack_from("<IIIH", data)
    begin = _HEAD + first * _POINT
    if not total:
        return np.zeros(0, dtype=np.uint32)
    (at,) = struct.unpack_from("<I", data, begin)
    states = np.frombuffer(data, dtype="<u8", count=LANES, offset=begin + 4).astype(np.uint64)
    words = np.frombuffer(data, dtype="<u4", count=count, offset=_HEAD + marks * _POINT)
    start = first * STRIDE
    stop = total if last is None or last >= marks else last * STRIDE
    out = np.empty(stop - start, dtype=np.uint32)
    for place in range(0, stop - start, LANES):
        lanes = min(LANES, stop - start - place)
        x = states[:lanes]
        slot = x & _MASK
        symbol = slots[slot]
        out[place : place + lanes] = symbol
        x = table.frequencies[symbol] * (x >> _SCALE) + slot - table.before[symbol]
        low = np.flatnonzero(x < _LOW)
        if len(low):
            x[low] = (x[low] << _WORD) | words[at : at + len(low)]
            at += len(low)
        states[:lanes] = x
    out = table.symbols[out]
    if first == 0 and stop == total and zlib.crc32(out.astype("<u4").tobytes()) != check:
        raise ValueError("a block's checksum does not fit its tokens")
    return out


def _prefixed(data: bytes) -> bytes:
    return struct.pack("<I", len(data)) + data


def encode_segment(tokens: np.ndarray, directory: bytes) -> bytes:
    """``directory`` is kept as it is, deflated."""
    blocks = [tokens[at : at + BLOCK] for at in range(0, len(tokens), BLOCK)]
    table = Table.fitted(tokens)
    parts = [table.packed(), zlib.compress(directory), *(encode_block(b, table) for b in blocks)]
    return MAGIC + struct.pack("<QI", len(tokens), len(blocks)) + b"".join(map(_prefixed, parts))


def _sections(data: bytes) -> Iterator[bytes]:
    at = len(MAGIC) + struct.calcsize("<QI")
    while at < len(data):
        (size,) = struct.unpack_from("<I", data, at)
        yield data[at + 4 : at + 4 + size]
        at += 4 + size


def decode_segment(data: bytes) -> tuple[bytes, Iterator[np.ndarray]]:
    """The directory and the tokens, block by block."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a segment of token ids")
    sections = _sections(data)
    table = Table.unpacked(next(sections))
    directory = zlib.decompress(next(sections))
    slots = table.slots()
    return directory, (decode_block(block, table, slots) for block in sections)


def crc32_joined(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings in a row, from that of each and the length of the second.

    Appending a zero byte to a string is a linear map of its crc32, as a matrix over two elements; its
    powers are found by squaring.
    """

    def times(matrix: list[int], vector: int) -> int:
        total = 0
        for row in matrix:
            if not vector:
                break
            if vector & 1:
                total ^= row
            vector >>= 1
        return total

    # One zero bit: shift right, and fold in the polynomial when a one falls out.
    power = [0xEDB88320, *(1 << n for n in range(31))]
    length *= 8
    while length:
        if length & 1:
            first = times(power, first)
        power = [times(power, row) for row in power]
        length >>= 1
    return first ^ second
