"""Drawing documents that resemble a target, by importance resampling on hashed word runs.

Line ends separate words, so every text is its lines. Lines that are equal have equal features: those of
each distinct line are counted once and multiplied by its occurrences. Runs of words that reach over a
line end are few; they are made per document and added. Once the buckets' gains are known, a distinct line is weighed
once, and a document's weight is the sum over its lines and its runs across them.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexistat.llm.shipping import ship
from lexistat.llm.words import whole_text
from lexistat.operators.ordering import global_index
from lexistat.session import stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
_BATCH_BYTES = 1 << 22

_DOCS = "doc_id long, n_words long, crossing array<int>, lines array<binary>, times array<int>"
# ASCII letters in lower case, digits and all beyond ASCII make words; everything else is a blank.
_BLANK = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def words(line: bytes) -> list[bytes]:
    return line.translate(_BLANK).split()


def line_digest(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def _crossing(lines: list[list[bytes]], buckets: int) -> list[int]:
    """Buckets of the runs of two and three words that do not lie in one of the ``lines``."""
    found: list[int] = []
    tail: list[bytes] = []
    for line in lines:
        for run in (
            (tail[-1:] + line[:1]) if tail else (),
            (tail + line[:1]) if len(tail) == 2 else (),
            (tail[-1:] + line[:2]) if tail and len(line) > 1 else (),
        ):
            if run:
                found.append(crc32(b" ".join(run)) % buckets)
        tail = (tail + line[-2:])[-2:]
    return found


def _documents(docs: DataFrame, buckets: int) -> DataFrame:
    """One row per document: its words, the buckets across line ends, its distinct lines and how often."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, crossing, lines, times = [], [], [], []
            for text in batch.column("text").to_pylist():
                filled = [(line, w) for line in text.encode().split(b"\n") if (w := words(line))]
                crossing.append(_crossing([w for _, w in filled], buckets))
                number.append(sum(len(w) for _, w in filled))
                often = Counter(line for line, _ in filled)
                lines.append([line_digest(line) for line in often])
                times.append([*often.values()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(number, pa.int64()),
                    pa.array(crossing, pa.list_(pa.int32())), pa.array(lines, pa.list_(pa.binary())),
                    pa.array(times, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_words", "crossing", "lines", "times"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(read, _DOCS).withColumn("_row", F.monotonically_increasing_id())


def distinct_lines(docs: DataFrame) -> DataFrame:
    """``(line, n)``: every different line that is not empty, and its occurrences."""
    each = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    return each.filter(F.col("line") != "").groupBy("line").agg(F.count("*").alias("n"))


def _features(lines: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and line of every feature: the checksum of a run goes on from that of the run before."""
    cut = [words(line) for line in lines]
    flat = [*chain.from_iterable(cut)]
    at = np.repeat(np.arange(len(cut)), [len(w) for w in cut])
    if not flat:
        return np.empty(0, np.int64), at
    spaced = [b" " + w for w in flat]
    ones = [*map(crc32, flat)]
    twos = [*map(crc32, spaced[1:], ones)]
    threes = map(crc32, spaced[2:], twos)
    second, third = at[1:] == at[:-1], at[2:] == at[:-2]
    number = [
        np.array(ones, np.int64),
        np.array(twos, np.int64)[second],
        np.fromiter(threes, np.int64, max(len(flat) - 2, 0))[third],
    ]
    return np.concatenate(number) % buckets, np.concatenate([at, at[1:][second], at[2:][third]])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """The lines of a batch in runs of bounded size, each with the place it begins at."""
    some: list[bytes] = []
    size = begin = 0
    for place, line in enumerate(batch.column("line")):
        some.append(line.as_buffer().to_pybytes())
        size += len(some[-1])
        if size >= _BATCH_BYTES:
            yield begin, some
            some, size, begin = [], 0, place + 1
    if some:
        yield begin, some


def bucket_counts(lines: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` over all ``lines(line, n)``: every line's features are made once."""
    ship(lines.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            often = batch.column("n").to_numpy()
            for begin, some in _slices(batch):
                bucket, at = _features(some, buckets)
                # Sums of whole numbers below 2**53 are exact.
                total += np.bincount(bucket, often[begin + at], buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return lines.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _line_weights(lines: DataFrame, gains: np.ndarray) -> DataFrame:
    """``(line, weight)`` by digest."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, some in _slices(batch):
                bucket, at = _features(some, len(gains))
                weight = np.bincount(at, gains[bucket], len(some)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(line_digest, some), pa.binary()), pa.array(weight)], ["line", "weight"]
                )

    return lines.select("line").mapInArrow(weigh, "line binary, weight long")


def gains_of(target: dict[int, int], raw: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket from its counts in the target and in all documents."""
    whole_target, whole_raw = sum(target.values()), sum(raw.values())

    def gain(bucket: int) -> int:
        t, s = float(target.get(bucket, 0)), float(raw.get(bucket, 0))
        return math.floor(
            1000 * math.log((t + 1) * (whole_raw + float(buckets)) / ((s + 1) * (whole_target + float(buckets))))
        )

    return np.array([gain(b) for b in range(buckets)], dtype=np.float64)


def _noise(seed: int) -> Column:
    """A Gumbel number of the document, from the digest of its id, times 1000 and rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((head + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row of ``docs``.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred are drawn: those
    of the highest scores, ties to the smaller id; the others have no rank. Null texts are empty: no features,
    weight 0. A null id is hashed as empty and comes behind all others among ties. Repeated rows
    count, weigh and are drawn one by one. No target text, or no document, leaves gains of equal
    meaning and defined; an empty ``docs`` gives no rows. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    own = stage(_documents(docs, buckets), "documents-by-line")
    lines = stage(distinct_lines(docs.select(whole_text().alias("text"))), "lines")
    reaching = own.select(F.explode("crossing").alias("bucket"))
    crossing = reaching.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.count("*").alias("n"))
    raw = bucket_counts(lines, buckets).unionByName(crossing).groupBy("bucket").agg(F.sum("n").alias("n"))
    wanted = target.select(whole_text().alias("line")).groupBy("line").agg(F.count("*").alias("n"))
    # One row per bucket: the number of buckets bounds what comes to the driver.
    gains = gains_of(
        {r["bucket"]: r["n"] for r in bucket_counts(wanted, buckets).collect()},
        {r["bucket"]: r["n"] for r in raw.collect()},
        buckets,
    )
    weights = stage(_line_weights(lines, gains), "line-weights")
    each = own.select("_row", F.explode(F.arrays_zip("lines", "times")).alias("l"))
    by_row = (
        each.select("_row", F.col("l.lines").alias("line"), F.col("l.times").alias("times"))
        .join(weights, "line")
        .groupBy("_row")
        .agg(F.sum(F.col("weight") * F.col("times")).alias("by_lines"))
    )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("crossing")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            at = np.repeat(np.arange(len(sizes)), sizes)
            total = np.bincount(at, gains[lists.flatten().to_numpy()], len(sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), batch.column("n_words"), pa.array(total)],
                ["_row", "doc_id", "n_words", "by_ends"],
            )

    narrow = own.select("_row", "doc_id", "n_words", "crossing").mapInArrow(
        across, "_row long, doc_id long, n_words long, by_ends long"
    )
    n = F.col("n_words")
    weighed = narrow.join(by_row, "_row", "left").select(
        "_row", "doc_id", "n_words",
        (n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n_features"),
        (F.col("by_ends") + F.coalesce("by_lines", F.lit(0))).alias("weight"),
    )
    scored = stage(weighed.withColumn("score", F.col("weight") + _noise(seed)), "scored")
    able = F.col("n_words") >= least_words
    most = percent * scored.filter(able).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("_row")]
    placed = global_index(scored.filter(able), order, "rank")
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
