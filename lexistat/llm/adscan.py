"""Approximate nearest neighbours by cosine: inverted lists scanned dimension by dimension.

Unit vectors are rotated by a random orthogonal matrix, so that the first d of D coordinates are a
random sample of a vector's length, and are dealt over the lists of the nearest centroids. A list lies in
blocks of bounded size, each stored by columns. A query probes its nearest lists. In a block it adds up
squared differences a few columns at a time; after d of them a candidate is given up when its
partial distance says, at the chosen confidence, that the whole one is over the query's k-th best:
partial > limit * d/D * (1 + EPSILON/sqrt(d))**2. Candidates that stay to the last column are
compared exactly on their original components.

Centroids are fitted on at most ``SAMPLE`` vectors; every vector is in the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.llm import vectors
from lexistat.llm.mtree import query_blocks
from lexistat.llm.shipping import ship
from lexistat.session import stage

SAMPLE = 16_384
MOST_LISTS = 1_024
ROUNDS = 8
PROBES = 0.7  # share of the lists that a query looks into
LEAST_PROBES = 16
BLOCK = 4096
QUERY_BLOCK = 256
COLUMNS = 16
EPSILON = 3.0
SEED = 11


def unit(points: np.ndarray) -> np.ndarray:
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def rotation(dim: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))[0]


def centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """Unit centroids of unit ``points`` by k-means; an empty list keeps its centroid."""
    chance = np.random.default_rng(SEED)
    centres = points[chance.choice(len(points), lists, replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def scan(columns: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the nearest candidates in a block, by squared distance and id; at most ``k``.

    The first candidates are compared in full and set the limit for the others.
    """
    dim, size = columns.shape
    order = np.flatnonzero(ids != own)
    first, rest = order[: 8 * k], order[8 * k :]
    kept = first
    exact = ((columns[:, first] - query[:, None]) ** 2).sum(axis=0)
    top = np.lexsort((ids[kept], exact))[:k]
    kept, exact = kept[top], exact[top]
    for begin in range(0, len(rest), 1024):
        alive = rest[begin : begin + 1024]
        limit = exact[-1] if len(exact) == k else np.inf
        partial = np.zeros(len(alive), dtype=columns.dtype)
        for done in range(0, dim, COLUMNS):
            some = slice(done, min(done + COLUMNS, dim))
            partial += ((columns[some, alive] - query[some, None]) ** 2).sum(axis=0)
            seen = some.stop
            factor = 1.0 if seen == dim else seen / dim * (1 + EPSILON / seen**0.5) ** 2
            stay = partial <= limit * factor + 1e-6
            alive, partial = alive[stay], partial[stay]
            if not len(alive):
                break
        if len(alive):
            kept, exact = np.concatenate([kept, alive]), np.concatenate([exact, partial])
            top = np.lexsort((ids[kept], exact))[:k]
            kept, exact = kept[top], exact[top]
    return kept


def fitted(rows: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The rotation and the rotated centroids for vectors of one dimension."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    points = unit(np.array([r["vector"] for r in chosen]))
    turn = rotation(points.shape[1])
    lists = max(1, min(MOST_LISTS, round(count**0.5 / 2), len(points) // 4))
    return turn, centroids(points @ turn, lists)


def index(
    rows: DataFrame, turn: np.ndarray, centres: np.ndarray, block: int = BLOCK
) -> tuple[DataFrame, np.ndarray]:
    """``(list, piece, data)``, staged: every vector in a block of its nearest centroid's list; and the lists' sizes.

    A long list is cut into pieces by a hash of the ids. Sizes are numbers of different ids; there are at most
    ``MOST_LISTS`` lists to count.
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                turned = unit(vectors.matrix(batch.column("vector"))) @ turn
                nearest = (turned @ centres.T).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], [*batch.schema.names, "list"])

    dealt = stage(
        rows.select("vec_id", "vector").mapInArrow(assign, "vec_id long, vector array<double>, list int"), "lists"
    )
    sizes = dealt.groupBy("list").count().select(
        "list", F.ceil(F.col("count") / block).alias("pieces")
    )
    pieced = dealt.join(F.broadcast(sizes), "list").withColumn(
        "piece", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("pieces")).cast("int")
    )

    def gather(key: tuple, group: pa.Table) -> pa.Table:
        points = vectors.matrix(group.column("vector"))
        columns = np.ascontiguousarray((unit(points) @ turn).T.astype(np.float32))
        data = vectors.packed(ids=group.column("vec_id").to_numpy(), columns=columns, points=points)
        return pa.table({"list": [key[0]], "piece": [key[1]], "data": [data]}).cast(
            pa.schema([("list", pa.int32()), ("piece", pa.int32()), ("data", pa.binary())])
        )

    blocks = stage(
        pieced.groupBy("list", "piece").applyInArrow(gather, "list int, piece int, data binary"), "blocks"
    )
    different = np.zeros(len(centres), dtype=np.int64)
    for row in dealt.select("list", "vec_id").distinct().groupBy("list").count().collect():
        different[row["list"]] = row["count"]
    return blocks, different


def probed(near: np.ndarray, sizes: np.ndarray, probes: int, k: int) -> np.ndarray:
    """The nearest ``probes`` lists of a query, given all in order, and more until they hold ``k`` other ids."""
    enough = np.searchsorted(np.cumsum(sizes[near]), k + 1) + 1
    return near[: max(probes, int(enough))]


def _one_dimension(rows: DataFrame, is_query: Column, k: int, count: int) -> DataFrame:
    turn, centres = fitted(rows, count)
    blocks, sizes = index(rows, turn, centres)
    probes = min(len(centres), max(LEAST_PROBES, round(PROBES * len(centres))))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                turned = unit(vectors.matrix(batch.column("vector"))) @ turn
                order = np.argsort(-(turned @ centres.T), axis=1, kind="stable")
                lists = [probed(near, sizes, probes, k) for near in order]
                at = pa.array(np.repeat(np.arange(len(batch)), [len(some) for some in lists]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(at), batch.column("vector").take(at),
                     pa.array(np.concatenate(lists).astype(np.int32))],
                    ["vec_id", "vector", "list"],
                )

    queries = rows.filter(is_query).dropDuplicates(["vec_id", "vector"]).select("vec_id", "vector")
    asked = query_blocks(
        queries.mapInArrow(probe, "vec_id long, vector array<double>, list int"), ["list"], QUERY_BLOCK,
        queries.count(),
    ).withColumnRenamed("data", "asked")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, asked in zip(batch.column("data"), batch.column("asked"), strict=True):
                held, block = vectors.unpacked(data.as_py()), vectors.unpacked(asked.as_py())
                ids, columns, points = held["ids"], held["columns"], held["points"]
                lengths = np.sqrt((points * points).sum(axis=1))
                turned = (unit(block["points"]) @ turn).astype(np.float32)
                names, found, scores = [], [], []
                for name, point, query in zip(block["ids"].tolist(), block["points"], turned, strict=True):
                    kept = scan(columns, ids, query, name, k)
                    length = np.sqrt((point * point).sum())
                    cosine = (points[kept] * point).sum(axis=1) / (lengths[kept] * length)
                    names += [name] * len(kept)
                    found += ids[kept].tolist()
                    scores += cosine.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    pairs = blocks.join(asked, "list").select("data", "asked")
    return vectors.best(pairs.mapInArrow(look, "query_id long, vec_id long, score double"), k)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def search(table: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``is_query`` holds for, near others by cosine.

    Zero vectors take no part, nor do those that ``vectors.usable`` leaves out. Each dimension has an
    index of its own. Rows that share an id are never each other's candidates; a repeated query row is
    answered once. Equal scores go by smaller id. A query looks into more lists where its nearest hold
    fewer than ``k`` other ids, so it gets ``k`` rows where there are as many.
    """
    spark = table.sparkSession
    ship(spark)
    nonzero = F.exists("vector", lambda x: x != 0)
    rows = stage(vectors.usable(table).filter(nonzero), "vectors")
    counts = rows.groupBy("dim").count().collect()  # one row per dimension
    out = _nothing(spark)
    for row in sorted(counts):
        same = rows.filter(F.col("dim") == row["dim"])
        out = out.unionByName(_one_dimension(same, is_query, k, row["count"]))
    return out
