"""Token counts of texts through a cache of digests.

The cache is a Parquet table ``(tokenizer, digest, n_tokens)`` that is only appended to. ``tokenizer`` is a
digest of the vocabulary file and the library's version, ``digest`` that of the normalised text. Counting
joins the documents' digests to the cache; each distinct text that it lacks is encoded once and appended, and all
counts are then read from the cache. Entries that two runs append at once are equal, and one is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from importlib.metadata import version
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexistat.llm.chunks import PIECE_BPE, Pieces
from lexistat.llm.shipping import ship
from lexistat.llm.tokens import Seen, batches, joinable, portions, spaced
from lexistat.llm.words import whole_text
from lexistat.session import stage

CACHE = "digest binary, n_tokens long, tokenizer string"
LIMIT = 4096


def tokenizer_digest(path: str) -> str:
    """Names a vocabulary file's content and the library that reads it, hexadecimal."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    known = hashlib.sha256(f"{library} {version(library)}\n".encode())
    known.update(Path(path).read_bytes())
    return known.hexdigest()


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@cache
def _piece_counter(path: str) -> tuple[Pieces, Seen[int]]:
    pieces = Pieces(path)

    def learn(words: list[str]) -> Iterable[int | None]:
        plain = [w for w in words if joinable(w)]
        joined = pieces.joined(plain)
        known = dict(zip(plain, np.diff(joined[1], prepend=0).tolist(), strict=True)) if joined else {}
        rest = [w for w in words if w not in known]
        known.update((w, None if ids is None else len(ids)) for w, ids in zip(rest, pieces.words(rest), strict=True))
        return map(known.__getitem__, words)

    return pieces, Seen(learn)


@cache
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def counts(texts: list[str], path: str = PIECE_BPE) -> list[int]:
    """Number of tokens of each text, as the library for the file gives them by default."""
    if path.endswith(".json"):
        return [len(x.ids) for x in _library(path).encode_batch_fast(texts, add_special_tokens=False)]
    pieces, seen = _piece_counter(path)
    # The parts of a very long text are counted one by one and added up.
    parts = [(place, part) for place, text in enumerate(texts) if text for part in portions(text)]
    total = [0] * len(texts)
    for some in batches(part for _, part in parts):
        here, parts = parts[: len(some)], parts[len(some) :]
        for (place, part), found in zip(here, seen.values([spaced(part) for part in some]), strict=True):
            total[place] += len(pieces.whole([part])[0]) if found is None else sum(found)
    return total


def read_cache(spark: SparkSession, folder: str, tokenizer: str) -> DataFrame:
    """``(digest, n_tokens)``, one row per digest; no rows where nothing has been appended yet."""
    # An append of nothing makes the folder, if there is none.
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(folder)
    stored = spark.read.schema(CACHE).parquet(folder).filter(F.col("tokenizer") == tokenizer)
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _append_missing(texts: DataFrame, keyed: DataFrame, folder: str, path: str) -> int:
    """Encode the distinct ``texts(digest, text)`` that the cache lacks; how many there were."""
    spark, tokenizer = texts.sparkSession, tokenizer_digest(path)
    distinct = keyed.select("digest").distinct()
    missing = stage(distinct.join(read_cache(spark, folder, tokenizer), "digest", "left_anti"), "missing")
    n = missing.count()
    if not n:
        return 0
    # A few missing digests choose the texts before those are moved. Of many, every task first
    # drops the copies among its own texts, so that a text found everywhere meets itself once per task.
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if n * 40 < limit:
        wanted = texts.join(F.broadcast(missing), "digest", "left_semi").dropDuplicates(["digest"])
    else:
        wanted = texts.dropDuplicates(["digest"]).join(missing, "digest", "left_semi")

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            found = counts(row.column("text").to_pylist(), path)
            yield pa.RecordBatch.from_arrays(
                [row.column("digest"), pa.array(found, pa.int64())], ["digest", "n_tokens"]
            )

    new = wanted.mapInArrow(encode, "digest binary, n_tokens long").withColumn("tokenizer", F.lit(tokenizer))
    new.write.mode("append").partitionBy("tokenizer").parquet(folder)
    return n


def count_tokens(
    docs: DataFrame, folder: str, path: str = PIECE_BPE, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row, by the cache in ``folder``.

    Null texts are empty and have no tokens. Repeated rows and equal texts are encoded once and returned
    as often as they come; null ids stay null. Other columns are not looked at. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    content = docs.select("doc_id", whole_text(text).alias("text")).withColumn("digest", text_digest(F.col("text")))
    keyed = stage(content.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "keyed")
    _append_missing(content.select("digest", "text"), keyed, folder, path)
    # One row per different text, written: a text found everywhere is then a key that the planner can split.
    stored = read_cache(docs.sparkSession, folder, tokenizer_digest(path))
    found = stage(keyed.select("digest").distinct().join(stored, "digest"), "counts")
    return keyed.join(found, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
