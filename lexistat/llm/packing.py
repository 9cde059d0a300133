"""Packing documents into token sequences by bounded-space best fit.

Documents are tokenized where they lie. A document longer than a sequence is cut from its end into
full pieces, so that only the first can be shorter; full pieces are sequences of their own. The other pieces
are dealt over the partitions by a hash, and every partition packs its own online, in the order of their
hashes, which tells nothing of their lengths and is the same in every run: a piece goes into the open
sequence that it fills best, found in a bitset with one bit per amount of free space. A fixed
number of sequences is open; when one more is needed, the fullest closes. What a partition holds is
that number of sequences, whatever it reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexistat.llm.shipping import ship
from lexistat.llm.tokens import BYTE_BPE, END, encoder
from lexistat.llm.words import parts_for
from lexistat.session import stage

SEQUENCE = 1024
OPEN = 256
PIECES_PER_PART = 50_000
_PART_BITS = 33

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


class OpenSequences:
    """Sequences being filled. Bit f of ``free`` is set while one with f free places is open."""

    def __init__(self, sequence: int, most: int) -> None:
        self.sequence, self.most = sequence, most
        self.by_free: list[list[int]] = [[] for _ in range(sequence + 1)]
        self.free = 0
        self.open = self.made = self.closed = 0  # closed: those that something was left free in

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.free &= ~(1 << free)
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The sequence for a piece and its offset there."""
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
                self.open -= 1
                self.closed += 1
            number, free = self.made, self.sequence
            self.made += 1
            self.open += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.free |= 1 << left
        else:
            self.open -= 1
        return number, self.sequence - free


def pieces(docs: DataFrame, path: str = BYTE_BPE, sequence: int = SEQUENCE) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document with its end id."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], dtype="<u4").tobytes()
        ids_of = encoder(path, True)
        for batch in batches:
            doc, number, start, length, check = [], [], [], [], []
            for name, ids in zip(
                batch.column("doc_id").to_pylist(), ids_of.encode(batch.column("text").to_pylist()),
                strict=True,
            ):
                ids += end
                view, total = memoryview(ids), len(ids) // 4
                begin, size = 0, total % sequence or sequence
                while begin < total:
                    doc.append(name)
                    number.append((begin + sequence - 1) // sequence)
                    start.append(begin)
                    length.append(size)
                    check.append(zlib.crc32(view[4 * begin : 4 * (begin + size)]))
                    begin, size = begin + size, sequence
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()), pa.array(check, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def filled(packed: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``(sequences, tokens, fill)`` of packed pieces: one row, ``fill`` from 0 to 1."""
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("held"))
    return sums.agg(F.count("*").alias("sequences"), F.sum("held").alias("tokens")).withColumn(
        "fill", F.col("tokens") / (F.col("sequences") * sequence)
    )


def pack(
    docs: DataFrame, path: str = BYTE_BPE, sequence: int = SEQUENCE, most_open: int = OPEN,
    per_part: int = PIECES_PER_PART,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Sequences hold at most ``sequence`` tokens without gaps. Null and empty texts are the end id alone.
    Repeated rows are packed once each. Sequence ids of full pieces are negative. An empty
    table gives no rows.
    """
    every = stage(pieces(docs, path, sequence), "pieces")
    full = every.filter(F.col("length") == sequence).select(
        *every.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).alias("offset")
    )
    short = every.filter(F.col("length") < sequence)
    parts = parts_for(short, short.count(), per_part)
    chance = F.xxhash64("doc_id", "start", "ids_crc32")
    dealt = short.repartition(parts, chance).sortWithinPartitions(chance, "doc_id", "start")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << _PART_BITS
        sequences = OpenSequences(sequence, most_open)
        for batch in batches:
            placed = [sequences.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([part + number for number, _ in placed], pa.int64()),
                    pa.array([offset for _, offset in placed], pa.int32()),
                ],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    packed = dealt.mapInArrow(fill, f"{PIECES}, sequence_id long, offset int")
    return full.unionByName(packed)
