"""Writing the token ids of documents as binary files in ascending order, and reading them back."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from lexistat.llm import ans
from lexistat.llm.shipping import ship
from lexistat.llm.tokens import END, WORD_BPE, encoder
from lexistat.llm.words import usual_parts
from lexistat.session import stage

SEGMENTS = StructType(
    [
        StructField("part", IntegerType()),
        StructField("segment", IntegerType()),
        StructField("before", LongType()),
        StructField("n_tokens", LongType()),
        StructField("data", BinaryType()),
    ]
)
_FRAGMENT = "part int, doc long, fragment int, doc_id long, start long, n_tokens long, ids_crc32 long"
# An entry of a directory: place of the document in its part, fragment, null mark, id, tokens.
_ENTRY = "<QI?qI"


class _Writer:
    """Gathers the documents of one part and gives out a segment whenever one is full."""

    def __init__(self) -> None:
        self.ids: list[bytes] = []
        self.entries: list[bytes] = []
        self.held = self.before = self.doc = self.segment = 0

    def _close(self) -> tuple[int, int, int, bytes]:
        tokens = np.frombuffer(b"".join(self.ids), dtype="<u4")
        row = (self.segment, self.before, len(tokens), ans.encode_segment(tokens, b"".join(self.entries)))
        self.before += len(tokens)
        self.segment += 1
        self.ids, self.entries, self.held = [], [], 0
        return row

    def add(self, name: int | None, ids: bytes) -> Iterator[tuple[int, int, int, bytes]]:
        """Documents stay whole unless they are longer than a segment."""
        total, at, fragment = len(ids) // 4, 0, 0
        if self.held and self.held + total > ans.SEGMENT:
            yield self._close()
        while at < total:
            size = min(total - at, ans.SEGMENT)
            self.ids.append(ids[4 * at : 4 * (at + size)])
            self.entries.append(struct.pack(_ENTRY, self.doc, fragment, name is None, name or 0, size))
            self.held += size
            at, fragment = at + size, fragment + 1
            if at < total:
                yield self._close()
        self.doc += 1

    def rest(self) -> Iterator[tuple[int, int, int, bytes]]:
        if self.held:
            yield self._close()


def write(docs: DataFrame, folder: str, path: str = WORD_BPE, parts: int | None = None) -> None:
    """Write the ids of every text and its end id to ``folder``, in ascending order of ``doc_id``.

    The documents are sorted over the partitions by ranges of their ids and tokenized there; every
    partition writes its own numbered part. Null ids come first; rows of equal id follow each other in the
    order of their texts' hashes, so that neither one id nor null is tied to one task, and equal rows alone may
    change places.
    """
    ship(docs.sparkSession)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = np.array([END], dtype="<u4").tobytes()
        writer, ids_of = _Writer(), encoder(path, False)

        def out(rows: Iterator[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
            for segment, before, size, data in rows:
                columns = [
                    pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([before], pa.int64()),
                    pa.array([size], pa.int64()), pa.array([data], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, SEGMENTS.names)

        for batch in batches:
            found = ids_of.encode(batch.column("text").to_pylist())
            for name, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                yield from out(writer.add(name, ids + end))
        yield from out(writer.rest())

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts or usual_parts(docs.sparkSession), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )
    ordered.mapInArrow(code, SEGMENTS).write.mode("overwrite").option("compression", "uncompressed").parquet(folder)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the files.

    ``start`` counts the ids of all documents before it. Segments are decoded independently. A
    document longer than a segment is joined again from its fragments; their number is its length over a
    segment's, and only such documents are shuffled.
    """
    ship(spark)
    files = segments(spark, folder)
    # One row per part; parts are as many as the partitions that wrote them.
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(
                batch.column("part").to_pylist(), batch.column("before").to_pylist(), batch.column("data"),
                strict=True,
            ):
                directory, blocks = ans.decode_segment(data.as_py())
                entries = list(struct.iter_unpack(_ENTRY, directory))
                tokens = memoryview(np.concatenate([*blocks]).astype("<u4").tobytes())
                sizes = np.array([e[4] for e in entries], dtype=np.int64)
                starts = before + np.cumsum(sizes) - sizes
                ends = (4 * np.cumsum(sizes)).tolist()
                checks = [
                    zlib.crc32(tokens[begin:end]) for begin, end in zip([0, *ends], ends, strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(entries), pa.int32()),
                        pa.array([e[0] for e in entries], pa.int64()),
                        pa.array([e[1] for e in entries], pa.int32()),
                        pa.array([None if e[2] else e[3] for e in entries], pa.int64()),
                        pa.array(starts), pa.array(sizes), pa.array(checks, pa.int64()),
                    ],
                    ["part", "doc", "fragment", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    found = stage(files.select("part", "before", "data").mapInArrow(decode, _FRAGMENT), "decoded")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            checks = []
            for pieces in batch.column("pieces").to_pylist():
                check = 0
                for piece in pieces:
                    check = ans.crc32_joined(check, piece["ids_crc32"], 4 * piece["n_tokens"])
                checks.append(check)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "doc_id", "start", "n_tokens")), pa.array(checks, pa.int64())],
                ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
            )

    # A fragment is as long as a segment, unless it is the last one of its document.
    fragments = found.filter((F.col("fragment") > 0) | (F.col("n_tokens") == ans.SEGMENT))
    whole = found.filter((F.col("fragment") == 0) & (F.col("n_tokens") < ans.SEGMENT))
    joined = fragments.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("fragment", "n_tokens", "ids_crc32"))).alias("pieces"),
    ).mapInArrow(join, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    every = whole.select("part", "doc_id", "start", "n_tokens", "ids_crc32").unionByName(joined)
    return every.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
