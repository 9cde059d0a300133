"""Exact top-k search by inner product over M-trees, best first.

Whole-number vectors x are put on a sphere by one more coordinate, sqrt(M**2 - |x|**2); a query gets 0
there. Then |q - x|**2 = |q|**2 + M**2 - 2 q.x, so the largest inner products are the nearest points of a
metric space. Vectors are dealt over trees of bounded size by a hash of their ids. A tree consists
of pages; an entry of an inner page is a routing vector with the radius that covers all below it, and every
entry keeps its distance to the routing vector of its page.

Queries go through a tree in blocks, so that a page is one matrix product. Each first goes down to the leaf
nearest to it; then the block visits pages in order of the least distance possible in them, each for the
queries that may find something there, and stops when that is over every k-th best. From the distances to a
page's routing vector and the stored ones, the triangle inequality rules entries out before their own
distance is computed. Scores are exact integers; bounds are widened by more than their rounding.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexistat.llm import vectors
from lexistat.llm.shipping import ship
from lexistat.session import MOST_PARTS, stage

TREE_ROWS = 8192
LARGER = 4  # times TREE_ROWS are in a tree where there are trees enough,
TREE_VALUES = 1 << 21  # if their components are no more than this
PAGE = 128
QUERY_BLOCK = 2048
BLOCKS = 8  # blocks of queries that one task takes through a tree
GRID = 256
SEED = 3


class Tree:
    """Pages lie one after another: entries ``starts[p]`` to ``starts[p + 1]`` are page p's; 0 is the root.

    ``child`` is the page below an entry, -1 in leaves.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray, starts: np.ndarray, child: np.ndarray,
                 radius: np.ndarray, parent: np.ndarray, sphere: np.ndarray) -> None:
        self.ids, self.starts, self.child = ids, starts.tolist(), child
        self.radius, self.parent, self.sphere = radius, parent, float(sphere)
        self.points = points
        self.computed = self.visited = 0  # distances and pages, for tests

    @staticmethod
    def built(ids: np.ndarray, points: np.ndarray) -> dict[str, np.ndarray]:
        """The arrays of a tree over whole-number ``points``."""
        whole, points = points, points.astype(np.float64)
        squares = (points * points).sum(axis=1)
        sphere = float(squares.max())
        chance = np.random.default_rng(SEED)

        def distances(at: np.ndarray, pivots: np.ndarray) -> np.ndarray:
            height = np.sqrt(np.maximum(sphere - squares, 0))
            inner = points[at] @ points[pivots].T + np.outer(height[at], height[pivots])
            return np.sqrt(np.maximum(2 * sphere - 2 * inner, 0))

        pages: list[tuple[list[int], list[int], list[float], np.ndarray]] = []

        def page(at: np.ndarray, routing: int | None) -> int:
            """Write the page over the rows ``at`` and those below it; its number."""
            number = len(pages)
            pages.append(([], [], [], np.zeros(0)))
            if len(at) <= PAGE:
                own = distances(at, np.array([routing]))[:, 0] if routing is not None else np.zeros(len(at))
                pages[number] = (at.tolist(), [-1] * len(at), [0.0] * len(at), own)
                return number
            pivots = chance.choice(at, min(PAGE, len(at) // (PAGE // 2)), replace=False)
            far = distances(at, pivots)
            nearest = far.argmin(axis=1)
            groups = [np.flatnonzero(nearest == j) for j in range(len(pivots))]
            if max(map(len, groups)) > 0.9 * len(at):  # mostly equal points: any halves will do
                groups = [np.array(part) for part in np.array_split(np.arange(len(at)), len(pivots))]
            entries, below, radii = [], [], []
            for j, group in enumerate(groups):
                if len(group):
                    entries.append(int(pivots[j]))
                    radii.append(float(far[group, j].max()))
                    below.append(page(at[group], int(pivots[j])))
            own = (
                distances(np.array(entries), np.array([routing]))[:, 0]
                if routing is not None else np.zeros(len(entries))
            )
            pages[number] = (entries, below, radii, own)
            return number

        page(np.arange(len(ids)), None)
        rows = np.array([i for p in pages for i in p[0]])
        return {
            "ids": ids[rows], "points": whole[rows],
            "starts": np.cumsum([0, *(len(p[0]) for p in pages)]),
            "child": np.array([c for p in pages for c in p[1]]),
            "radius": np.array([r for p in pages for r in p[2]]),
            "parent": np.concatenate([p[3] for p in pages]), "sphere": np.array(sphere),
        }

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """``(score, id)`` of the ``k`` best but ``own``, ties to smaller ids."""
        _, scores, ids = self.search_all(np.array([own]), query[None, :], k)
        return list(zip(scores.tolist(), ids.tolist(), strict=True))

    def search_all(self, own: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the queries, scores and ids of the ``k`` best of each but those of its ``own`` id."""
        kind = exact_type(self.points, queries)
        points, asked = self.points.astype(kind, copy=False), queries.astype(kind, copy=False)
        doubles = queries.astype(np.float64)
        square = (doubles * doubles).sum(axis=1) + self.sphere
        slack = 1e-6 * (1 + np.sqrt(square))
        count = len(own)
        lowest = -np.inf if kind != np.int64 else np.iinfo(np.int64).min + 1
        top = np.full((count, k), lowest, dtype=kind)  # best first; the first ``found`` are there
        names = np.zeros((count, k), dtype=np.int64)
        found = np.zeros(count, dtype=np.int64)
        limit = np.full(count, np.inf)

        def sure(at: np.ndarray, who: np.ndarray, to_routing: np.ndarray) -> bool:
            """True where the extremes already tell that the stored distances rule nothing out."""
            if not len(who):
                return True
            parent = self.parent[at]
            widest = max(to_routing.max() - parent.min(), parent.max() - to_routing.min())
            return widest - self.radius[at].min() <= limit[who].min()

        def scores(number: int, who: np.ndarray, to_routing: np.ndarray | None) -> tuple[np.ndarray, ...]:
            """The queries and the places of entries that the stored distances leave, and their scores."""
            at = np.arange(self.starts[number], self.starts[number + 1])
            if to_routing is not None and not sure(at, who, to_routing):
                hope = np.abs(to_routing[:, None] - self.parent[at]) - self.radius[at] <= limit[who, None]
                some = hope.any(axis=1)
                who, at = who[some], at[hope.any(axis=0)]
            self.computed += len(who) * len(at)
            self.visited += 1
            asking = asked if len(who) == count else asked[who]  # always in order
            return who, at, asking @ points[at].T

        def enter(who: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
            """Let the rows of a leaf into the best of the queries."""
            if not len(at):
                return
            rows = np.flatnonzero(score.max(axis=1) >= top[who, -1])
            who, score = who[rows], score[rows]
            worst = top[who, -1:]
            may = (score > worst) | ((score == worst) & (self.ids[at] < names[who, -1:]))
            may &= self.ids[at] != own[who, None]
            new = may.sum(axis=1)
            if not new.any():
                return
            first = np.argsort(~may, axis=1, kind="stable")[:, : new.max()]
            score = np.where(np.take_along_axis(may, first, 1), np.take_along_axis(score, first, 1), lowest)
            score = np.concatenate([top[who], score], axis=1)
            ids = np.concatenate([names[who], self.ids[at][first]], axis=1)
            order = np.lexsort((ids, -score), axis=1)[:, :k]
            top[who] = np.take_along_axis(score, order, 1)
            names[who] = np.take_along_axis(ids, order, 1)
            found[who] = np.minimum(found[who] + new, k)
            full = who[found[who] == k]
            worst = top[full, -1].astype(np.float64)
            limit[full] = np.sqrt(np.maximum(square[full] - 2.0 * worst, 0)) + slack[full]

        def distances(who: np.ndarray, score: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(square[who, None] - 2.0 * score.astype(np.float64), 0))

        nearest_leaf = np.zeros(count, dtype=np.int64)
        down = [(0, np.arange(count))]
        while down:
            number, who = down.pop()
            who, at, score = scores(number, who, None)
            if self.child[at[0]] < 0:
                enter(who, at, score)
                nearest_leaf[who] = number
                continue
            nearest = distances(who, score).argmin(axis=1)
            down += [(int(self.child[at[e]]), who[nearest == e]) for e in np.unique(nearest)]

        queue: list[tuple] = [(0.0, 0, np.arange(count), np.zeros(count), None)]
        while queue:
            least, number, who, bound, to_routing = heapq.heappop(queue)
            if least > limit.max():
                break
            leaf = self.child[self.starts[number]] < 0
            stay = bound <= limit[who]
            if leaf:
                stay &= nearest_leaf[who] != number
            who, at, score = scores(number, who[stay], to_routing[stay] if to_routing is not None else None)
            if leaf:
                enter(who, at, score)
                continue
            distance = distances(who, score)
            bound = np.maximum(distance - self.radius[at] - slack[who, None], 0)
            may = bound <= limit[who, None]
            for e in np.flatnonzero(may.any(axis=0)):
                some = may[:, e]
                below = bound[some, e]
                heapq.heappush(queue, (below.min(), int(self.child[at[e]]), who[some], below, distance[some, e]))
        at = np.arange(k) < found[:, None]
        return np.repeat(np.arange(count), found), top[at].astype(np.int64), names[at]


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest type in which all inner products of rows of whole numbers are exact."""
    if not a.size or not b.size:
        return np.float64
    largest = [max(float(x.max()), -float(x.min())) for x in (a, b)]
    bound = largest[0] * largest[1] * a.shape[1]
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def on_grid(points: np.ndarray) -> np.ndarray:
    """floor(256 x) in the smallest integers that hold all of them."""
    whole = np.floor(points * GRID)
    largest = float(np.abs(whole).max()) if whole.size else 0.0
    return whole.astype(next((t for t in (np.int16, np.int32) if largest <= np.iinfo(t).max), np.int64))


def tree_count(rows: int, dim: int | None, tree_rows: int, cores: int) -> int:
    """Trees of ``tree_rows``, but larger ones where each core would have more than four: what moves is one copy
    of the queries for each tree."""
    most = max(tree_rows, min(LARGER * tree_rows, TREE_VALUES // (dim or 1)))
    return max(1, -(-rows // most), min(-(-rows // tree_rows), 4 * cores))


def trees(rows: DataFrame, buckets: int) -> DataFrame:
    """``(dim, tree, data)``: one tree per dimension and hash bucket, staged."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        arrays = Tree.built(
            group.column("vec_id").to_numpy(), on_grid(vectors.matrix(group.column("vector")))
        )
        return pa.table({"dim": [key[0]], "tree": [key[1]], "data": [vectors.packed(**arrays)]}).cast(
            pa.schema([("dim", pa.int32()), ("tree", pa.int64()), ("data", pa.binary())])
        )

    dealt = rows.withColumn("tree", F.pmod(F.xxhash64("vec_id"), F.lit(buckets)))
    return stage(
        dealt.groupBy("dim", "tree").applyInArrow(build, "dim int, tree long, data binary"), "trees"
    )


def query_blocks(
    queries: DataFrame, keys: list[str], size: int, count: int,
    form: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """``keys``, ``block`` and ``data``: queries in blocks of about ``size`` for each key, vectors in ``form``."""
    blocks = max(1, -(-count // size))

    def gather(key: tuple, group: pa.Table) -> pa.Table:
        points = vectors.matrix(group.column("vector"))
        data = vectors.packed(
            ids=group.column("vec_id").to_numpy(), points=form(points) if form else points
        )
        names = {name: [value] for name, value in zip([*keys, "block"], key, strict=True)}
        return pa.table({**names, "data": [data]}).cast(
            pa.schema([*((name, pa.int32()) for name in keys), ("block", pa.int64()), ("data", pa.binary())])
        )

    schema = ", ".join([*(f"{name} int" for name in keys), "block long", "data binary"])
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)))
    return dealt.groupBy(*keys, "block").applyInArrow(gather, schema)


def search(table: DataFrame, is_query: Column, k: int = 5, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``is_query`` holds for, the ``k`` best others.

    Queries go through every tree in blocks; a task has one tree and at most ``BLOCKS`` blocks at a time, so
    its memory does not grow with the table. Vectors are compared with those of their own dimension; see
    ``vectors.usable`` for those that take no part. Rows that share an id are never each other's
    candidates; a repeated query row is answered once. Fewer than ``k`` candidates give fewer rows.
    """
    ship(table.sparkSession)
    rows = stage(vectors.usable(table), "vectors")
    queries = rows.filter(is_query).dropDuplicates(["vec_id", "vector"])
    count = queries.count()
    parts = max(1, -(-count // (QUERY_BLOCK * BLOCKS)))
    cores = table.sparkSession.sparkContext.defaultParallelism
    buckets = tree_count(*rows.agg(F.count("*"), F.max("dim")).first(), tree_rows, cores)
    key = ["dim", "tree", "part"]
    tasks = min(max(cores, 4 * buckets * parts), MOST_PARTS)  # so that few keys share one

    def copies(column: str, number: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias(column)

    asked = (
        query_blocks(queries, ["dim"], QUERY_BLOCK, count, on_grid)
        .select("dim", copies("tree", buckets), F.pmod("block", F.lit(parts)).alias("part"), "data")
        .repartition(tasks, *key)
    )
    placed = trees(rows, buckets).select("dim", "tree", copies("part", parts), "data").repartition(tasks, *key)

    def look(held: pa.Table, blocks: pa.Table) -> pa.Table:
        out = [[np.zeros(0, dtype=np.int64)] for _ in range(3)]
        for data in held.column("data"):
            tree = Tree(**vectors.unpacked(data.as_py()))
            for block in blocks.column("data"):
                asking = vectors.unpacked(block.as_py())
                who, scores, ids = tree.search_all(asking["ids"], asking["points"], k)
                for all_of, some in zip(out, (asking["ids"][who], scores, ids), strict=True):
                    all_of.append(some)
        return pa.table(dict(zip(["query_id", "score", "vec_id"], map(np.concatenate, out), strict=True)))

    found = placed.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        look, "query_id long, score long, vec_id long"
    )
    return vectors.best(found, k)


# The scores of op3's query over all candidates.
SQL = f"""
WITH fine AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({GRID} * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM fine q JOIN fine c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
