"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles, hashed to 64 bits. Equal sets are one vertex from the
start, so thousands of exact copies cost one. Every vertex has a signature of minwise tokens. A tree branches
the vertices by the token at one coordinate; nodes of more than ``SMALL_NODE`` vertices branch
further, each into the tokens at ``CHILDREN`` other coordinates. Vertices that share a small node are compared
exhaustively on their signatures, with a wide margin, and ``TREES`` trees with coordinates of
their own are grown: a pair of similarity s meets in one with probability s at its root alone, so for s = 0.8
all ten miss it once in ten million.

Pairs are never listed. A node gives the edges of a spanning forest of what may be linked, the components of
these edges are blocks, and every link lies inside a block. The full sets of a block's documents are then brought
together once, and components are searched on exact intersections. A block too large for one task is verified
node by node instead, and its nodes' results are joined. Nodes that stay large to the last level are
compared piece by piece, each piece with each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexistat.llm.components import components
from lexistat.llm.shipping import ship
from lexistat.llm.words import row_of, usual_parts
from lexistat.session import stage

WORDS = 5
PERCENT = 80  # least similarity
TOKENS = 64
TREES = 10
LEVELS = 3  # of branching below a root
CHILDREN = 2
SMALL_NODE = 2048
MARGIN = 0.22  # five standard errors of a similarity estimated from a signature
BLOCK_DOCS = 16_384
BLOCK_SHINGLES = 8_000_000
SEED = 5
_KEPT_WORDS = 200_000

_odd = np.random.default_rng(SEED).integers(1, 1 << 63, 8 + TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_words: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _odd[0]
    x = (x ^ (x >> np.uint64(29))) * _odd[1]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; of all words if they are fewer.

    Words are runs of anything but ASCII white space, with A-Z lowered.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(_words) > _KEPT_WORDS:
        _words.clear()
    for word in set(words).difference(_words):
        _words[word] = xxhash.xxh64_intdigest(word)
    hashes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    run = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for step in range(size):
        run = _mixed(run + hashes[step : len(words) - size + 1 + step])
    return np.unique(run)


def signature(found: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set: for each coordinate the least of its hashes, to 32 bits."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(found), 4096):
        np.minimum(least, (found[begin : begin + 4096, None] * _odd[None, 8:]).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def shingled(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, n, fp, tokens)``: size, 128-bit fingerprint and signature of every document's set."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, prints, tokens = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, size)
                data = found.astype("<u8").tobytes()
                count.append(len(found))
                prints.append(xxhash.xxh3_128_digest(data))
                tokens.append(signature(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(tokens, pa.binary())],
                ["doc_id", "n", "fp", "tokens"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        measure, "doc_id long, n long, fp binary, tokens binary"
    )


def token(place: Column) -> Column:
    return F.substring("tokens", place * 4 + 1, F.lit(4))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal ``key`` of sorted batches, whole across batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if held and begin == 0 and held[-1].column(key)[0].as_py() != keys[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            if end < len(keys):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def forest(ids: np.ndarray, near: Callable[[int], np.ndarray]) -> list[tuple[int, int]]:
    """``(id, smallest id of its component)`` for components of at least two places.

    ``near(i)`` marks the places linked with place i. Every place is expanded once.
    """
    order = np.argsort(ids, kind="stable")
    open_, out = np.ones(len(ids), dtype=bool), []
    for root in order.tolist():
        if not open_[root]:
            continue
        open_[root] = False
        members, queue = [root], [root]
        while queue:
            fresh = np.flatnonzero(near(queue.pop()) & open_)
            open_[fresh] = False
            members += fresh.tolist()
            queue += fresh.tolist()
        if len(members) > 1:
            label = int(ids[root])
            out += [(int(ids[m]), label) for m in members]
    return out


def nodes(vertices: DataFrame) -> DataFrame:
    """``(node, tree, vertex, tokens)``: the vertices of every node that is compared, of two or more each.

    Level by level: a node of one vertex ends, a small one is kept, a large one branches; at the last level a large
    one is dealt over pieces, and every pair of pieces is a node.
    """
    coordinate = F.col("tree") * (1 + LEVELS * CHILDREN)
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    entries = vertices.select("vertex", "tokens", trees.alias("tree")).select(
        "vertex", "tree", F.xxhash64("tree", token(coordinate % TOKENS)).alias("node")
    )
    kept: DataFrame | None = None
    for level in range(LEVELS + 1):
        entries = stage(entries.distinct(), "entries")
        sizes = stage(
            entries.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes"
        )
        shared = entries.join(sizes, "node")
        small = shared.filter(F.col("size") <= SMALL_NODE).select("node", "tree", "vertex")
        kept = small if kept is None else kept.unionByName(small)
        if not sizes.filter(F.col("size") > SMALL_NODE).limit(1).count():
            break
        large = shared.filter(F.col("size") > SMALL_NODE)
        if level < LEVELS:
            child = F.explode(F.array(*[F.lit(1 + level * CHILDREN + c) for c in range(CHILDREN)]))
            entries = large.select("node", "tree", "vertex", child.alias("child")).join(vertices, "vertex").select(
                "vertex", "tree",
                F.xxhash64("node", "child", token((coordinate + F.col("child")) % TOKENS)).alias("node"),
            )
            continue
        pieces = F.ceil(F.col("size") * 2 / SMALL_NODE)
        dealt = large.withColumn("pieces", pieces).withColumn(
            "piece", F.pmod(F.xxhash64("vertex", "node"), F.col("pieces"))
        )
        met = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
        kept = kept.unionByName(
            dealt.withColumn("other", met).select(
                F.xxhash64("node", F.least("piece", "other"), F.greatest("piece", "other")).alias("node"),
                "tree", "vertex",
            )
        )
    return stage(kept, "nodes")


def candidates(vertices: DataFrame, kept: DataFrame, least: float) -> DataFrame:
    """``(a, b)``: spanning edges of the pairs in each node whose signatures agree in ``least`` of the tokens."""
    needed = least * TOKENS

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "node"):
            ids = group.column("vertex").to_numpy()
            if len(ids) < 2:
                continue
            data = b"".join(group.column("tokens").to_pylist())
            tokens = np.frombuffer(data, dtype="<u4").reshape(len(ids), TOKENS)
            edges = forest(ids, lambda i, t=tokens: (t == t[i]).sum(axis=1) >= needed)
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    parts = usual_parts(vertices.sparkSession)
    dealt = kept.select("node", "vertex").join(vertices.select("vertex", "tokens"), "vertex")
    return (
        dealt.select("node", "vertex", "tokens").repartition(parts, "node").sortWithinPartitions("node")
        .mapInArrow(compare, "a long, b long").filter("a <> b").distinct()
    )


class Sets:
    """The sets of a block, for exact intersections of one with all.

    Shingles that over half of the sets hold are the core. A set is kept as what it lacks of the core
    and what it has besides, so that near copies are short lists:
    |x & y| = core - lacks(x) - lacks(y) + |both lack| + |both have besides|.
    """

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        core = counts * 2 > len(sets)
        self.core = int(core.sum())
        besides = ~core[column]
        lacking_owner, lacking_column = self._lacking(owner, column, core, len(sets))
        self.lacks = np.bincount(lacking_owner, minlength=len(sets))
        # Besides and lacks as two kinds of columns of one table; columns with one owner meet nobody.
        owners = np.concatenate([owner[besides], lacking_owner])
        columns = np.concatenate([column[besides], lacking_column + len(counts)])
        shared = np.bincount(columns, minlength=2 * len(counts))[columns] > 1
        owners, columns = owners[shared], columns[shared]
        by_column = np.argsort(columns, kind="stable")
        self.posting = owners[by_column]
        self.bounds = np.searchsorted(columns[by_column], np.arange(2 * len(counts) + 1))
        by_owner = np.argsort(owners, kind="stable")
        self.columns = columns[by_owner]
        self.own = np.searchsorted(owners[by_owner], np.arange(len(sets) + 1))

    @staticmethod
    def _lacking(owner: np.ndarray, column: np.ndarray, core: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        names = np.flatnonzero(core)
        if not len(names):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        place = np.cumsum(core) - 1
        owners, columns = [], []
        inside = core[column]
        owner, column = owner[inside], place[column[inside]]
        bounds = np.searchsorted(owner, np.arange(count + 1))
        for i in range(count):
            absent = np.ones(len(names), dtype=bool)
            absent[column[bounds[i] : bounds[i + 1]]] = False
            lacking = names[absent]
            owners.append(np.full(len(lacking), i))
            columns.append(lacking)
        return np.concatenate(owners), np.concatenate(columns)

    def linked(self, i: int) -> np.ndarray:
        """The sets whose similarity with set i reaches the limit."""
        held = self.columns[self.own[i] : self.own[i + 1]]
        lists = [self.posting[self.bounds[c] : self.bounds[c + 1]] for c in held.tolist()]
        meet = np.bincount(np.concatenate(lists), minlength=len(self.sizes)) if lists else 0
        both = self.core - self.lacks[i] - self.lacks + meet
        return 100 * both >= self.percent * (self.sizes + self.sizes[i] - both)


def verified(units: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``(a, b)``: for ``units(unit, vertex)``, each linked vertex and the smallest of its component in the unit."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, size).astype("<u8").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vertex"), batch.column("units"), pa.array(sets, pa.binary())], ["vertex", "units", "held"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "unit"):
            if len(group) < 2:
                continue
            sets = [np.frombuffer(x, dtype="<u8") for x in group.column("held").to_pylist()]
            edges = forest(group.column("vertex").to_numpy(), Sets(sets, percent).linked)
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    lists = units.groupBy("vertex").agg(F.collect_set("unit").alias("units"))
    texts = docs.select(F.col("doc_id").cast("long").alias("vertex"), "text").join(lists, "vertex")
    held = texts.mapInArrow(cut, "vertex long, units array<long>, held binary").select(
        "vertex", F.explode("units").alias("unit"), "held"
    )
    parts = usual_parts(docs.sparkSession)
    return (
        held.repartition(parts, "unit").sortWithinPartitions("unit", "vertex").mapInArrow(compare, "a long, b long")
        .distinct()
    )


def linked(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Documents are linked when 100 * |x & y| >= percent * |x | y| for their shingle sets.
    ``component_id`` is the smallest id that links lead to, the own one included; ``kept`` marks the
    document of that id. Texts without words, null ones included, are empty sets and linked with nothing. Rows
    that share an id are one document. Rows of null id take no part: they have no component and are
    kept. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    rows = stage(shingled(docs, size), "shingled")
    usable = rows.filter("doc_id IS NOT NULL AND n > 0")
    classes = stage(
        usable.groupBy("fp").agg(F.min("doc_id").alias("vertex"), F.first("tokens").alias("tokens"), F.first("n").alias("n")),
        "classes",
    )
    vertices = classes.select("vertex", "tokens")
    kept = nodes(vertices)
    blocks = components(candidates(vertices, kept, percent / 100 - MARGIN)).toDF("vertex", "block")
    measured = blocks.join(classes.select("vertex", "n"), "vertex").groupBy("block").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles")
    )
    too_large = (F.col("docs") > BLOCK_DOCS) | (F.col("shingles") > BLOCK_SHINGLES)
    huge = stage(measured.filter(too_large).select("block"), "huge")
    units = blocks.join(huge, "block", "left_anti").select(F.col("block").alias("unit"), "vertex")
    if huge.limit(1).count():
        inside = blocks.join(huge, "block", "left_semi")
        units = units.unionByName(
            kept.join(inside, "vertex").select(F.xxhash64("node", "block").alias("unit"), "vertex")
        )
    # The class's own document holds its set; other documents of the same id are vertices of that id too.
    labels = components(verified(units, docs, size, percent)).toDF("vertex", "label")
    of_class = classes.select("fp", "vertex").join(labels, "vertex", "left").select(
        "fp", F.coalesce("label", "vertex").alias("component_id")
    )
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return rows.select("doc_id", "n", "fp").join(of_class, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component; same columns."""
    gone = linked(docs, size, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.select(row_of(docs), F.col("doc_id").cast("long").alias("_id"))
    return rows.join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("_row.*")


# The links of op2's query from all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                                   WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                                   ELSE list_transform(range(1, len(w) - 1),
                                        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
        FROM cut)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), met AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT x, y FROM met JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
    WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), edge AS (
    SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, e.y FROM reached r JOIN edge e ON e.x = r.other
), component AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)
"""
