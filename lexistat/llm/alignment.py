"""Aligning the tokens of two vocabularies by white-space anchors.

Where tokens of both vocabularies end at the same byte and both next tokens begin with a space, a text is cut: what
lies between two such anchors is a window, a few ids on either side. Texts repeat windows, so the
alignment of a window (its groups, its links) is worked out once for its two tuples of ids and looked up from then
on, by the ids or by the word that gave them. A window learned from a word is one whose ids are those of
the whole text, whose bytes are the word's and whose first tokens both begin with the space before it; a
text with any other word is tokenized as a whole and cut at the anchors that its tokens show.

How often two ids are linked is counted over all documents. Documents keep their linked pairs with
counts; those are added per task before they are shuffled, and come back to the documents as one
table, in memory where its size is proven and by a join beyond that.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexistat.llm.chunks import PIECE_BPE, Pieces
from lexistat.llm.shipping import ship
from lexistat.llm.tokens import BYTE_BPE, Encoder, Seen, batches, byte_level_bytes, joinable, portions, spaced
from lexistat.session import stage

KEPT_WINDOWS = 200_000  # in each of two generations
KEPT_PAIRS = 1_000_000
# A table of up to this many pairs (17 bytes each) is sent to the tasks; a larger one is joined.
SENT_PAIRS = 4_000_000
_A_BITS = 32

_TEXTS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)
_RESULT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
_BETWEEN = (",", "|", ";", "\n")  # ids of one side, the sides of a group, groups, windows


# Two runs of ids over the same bytes, as 32-bit integers.
Ids = tuple[bytes, bytes]
# Their alignment: the groups as in a1,a2|b1;a3|b2, the number of ids of the first run, and the keys of the linked
# pairs as 64-bit integers, one per overlap.
Window = tuple[str, int, bytes]


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Aligner:
    """Windows of texts in both vocabularies, a bounded number of them kept."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.encoder = Encoder(path_a, True)
        self.encoder.library.encode_special_tokens = True
        self.pieces = Pieces(path_b)
        self.bytes_a, self.bytes_b = byte_level_bytes(self.encoder.library.get_vocab()), self.pieces.bytes
        self.size_a, self.size_b = (np.array([len(x) for x in e]) for e in (self.bytes_a, self.bytes_b))
        self.marked_a, self.marked_b = np.array([x[:1] == b" " for x in self.bytes_a]), self.pieces.marked
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{sign}" for i in range(most) for sign in _BETWEEN]
        self.by_ids: Seen[Window] = Seen(self.align, KEPT_WINDOWS // 8)
        self.by_word: Seen[Window] = Seen(self._learn, KEPT_WINDOWS)

    def _aligned(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[Window]:
        """The alignments of many windows at once; both runs of each cover the same bytes."""
        n_a, n_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        ends_a, ends_b = self.size_a[a].cumsum(), self.size_b[b].cumsum()
        of_a, of_b = (np.repeat(np.arange(len(n)), n) for n in (n_a, n_b))
        # Between two neighbouring ends of either side one token of each overlap.
        marks = np.zeros(int(ends_a[-1]) + 1, np.int8)
        marks[ends_a] = 1
        marks[ends_b] += 2
        ends = np.flatnonzero(marks)
        in_a, in_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = (b[in_b].astype(np.int64) << _A_BITS | a[in_a]).tobytes()
        link_ends = 8 * np.bincount(of_a[in_a], minlength=len(n_a)).cumsum()
        shared = np.flatnonzero(marks == 3)
        group = np.concatenate([np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        group, side = group[order], side[order]
        window = np.concatenate([of_a, of_b])[order]
        sign = np.full(len(order), 3)
        sign[:-1] = np.where(
            window[1:] != window[:-1], 3, np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
        )
        codes = (np.concatenate([a, b])[order].astype(np.int64) * len(_BETWEEN) + sign).tolist()
        texts = "".join(map(self.written.__getitem__, codes)).split("\n")
        ends = link_ends.tolist()
        # The last text is what follows the end of the last window: nothing.
        return [
            (text, size, links[begin:end])
            for text, size, begin, end in zip(texts[:-1], n_a.tolist(), [0, *ends[:-1]], ends, strict=True)
        ]

    def align(self, windows: list[Ids]) -> list[Window]:
        """The alignments of windows by their ids."""
        ids = (np.frombuffer(b"".join([w[side] for w in windows]), "<u4") for side in (0, 1))
        return self._aligned(*ids, *(np.cumsum([len(w[side]) // 4 for w in windows]) for side in (0, 1)))

    def _joined(self, words: list[str]) -> dict[str, Window]:
        """The windows of words that are encoded as one text; none where one of them is not a window."""
        of_a, of_b = self.encoder.joined.encode(words), self.pieces.joined(words)
        if of_a is None or of_b is None:
            return {}
        (a, cuts_a), (b, cuts_b) = of_a, of_b
        # Both next tokens of an anchor begin with a space.
        begin_a, begin_b = (np.append(0, cuts[:-1]) for cuts in (cuts_a, cuts_b))
        if not (self.marked_a[a[begin_a]].all() and self.marked_b[b[begin_b]].all()):
            return {}
        return dict(zip(words, self._aligned(a, b, cuts_a, cuts_b), strict=True))

    def _learn(self, words: list[str]) -> Iterator[Window | None]:
        """The windows of words with the space before each; None where there is no anchor or other bytes."""
        known: dict[str, Window | None] = dict(self._joined([w for w in words if joinable(w)]))
        rest = [w for w in words if w not in known]
        ids = {}
        for word, a, b in zip(rest, self._ids_a([" " + w for w in rest]), self.pieces.words(rest), strict=True):
            if b and self.marked_a[a[0]] and self.marked_b[b[0]]:
                ids[word] = (_packed(a), _packed(b))
        (found,) = self.by_ids.values([[*ids.values()]])
        known.update(zip(ids, found, strict=True))
        return (known.get(word) for word in words)

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.encoder.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, text: str) -> list[Window]:
        """The windows of a text that is tokenized as a whole, none where its bytes are not given back."""
        (ids_a,), (ids_b,) = self._ids_a([" " + text]), self.pieces.whole([text])
        wanted = (" " + text).encode()
        for ids, entries in ((ids_a, self.bytes_a), (ids_b, self.bytes_b)):
            if b"".join([entries[i] for i in ids]) != wanted:
                return []
        a, b = np.array(ids_a), np.array(ids_b)
        ends_a, ends_b = self.size_a[a].cumsum(), self.size_b[b].cumsum()
        shared = np.intersect1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, shared) + 1, np.searchsorted(ends_b, shared) + 1
        anchor = self.marked_a[a[at_a[:-1]]] & self.marked_b[b[at_b[:-1]]]
        cuts_a = [0, *at_a[:-1][anchor].tolist(), len(a)]
        cuts_b = [0, *at_b[:-1][anchor].tolist(), len(b)]
        windows = [
            (_packed(ids_a[i:j]), _packed(ids_b[k:m]))
            for i, j, k, m in zip(cuts_a[:-1], cuts_a[1:], cuts_b[:-1], cuts_b[1:], strict=True)
        ]
        (found,) = self.by_ids.values([windows])
        return found

    def windows(self, texts: list[str]) -> Iterator[list[Window]]:
        """The windows of every text; none where it is empty or has no tokens."""
        parts = [(place, part) for place, text in enumerate(texts) if text for part in portions(text)]
        found: list[list[Window] | None] = [[] for _ in texts]
        values = self.by_word.values([spaced(part) for _, part in parts])
        for (place, part), some in zip(parts, values, strict=True):
            some = self._whole(part) if some is None else some
            # One part that is not given back is a text that is not.
            found[place] = found[place] + some if some and found[place] is not None else None
        return (some or [] for some in found)


@cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _aligned(texts: list[str], path_a: str, path_b: str) -> list[pa.Array]:
    """The columns of ``_TEXTS`` behind the id."""
    n_a, n_b, groups, links, digest, pairs, times = ([] for _ in range(7))
    for found in _aligner(path_a, path_b).windows(texts):
        text = ";".join([w[0] for w in found])
        keys, often = np.unique(np.frombuffer(b"".join([w[2] for w in found]), np.int64), return_counts=True)
        n_a.append(sum([w[1] for w in found]))
        groups.append(text.count("|"))
        links.append(int(often.sum()))
        # A group of i and j ids has i + j - 1 links.
        n_b.append(links[-1] + groups[-1] - n_a[-1])
        digest.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
        pairs.append(keys)
        times.append(often)
    offsets = np.cumsum([0, *map(len, pairs)]).astype(np.int32)
    return [
        *(pa.array(x, pa.int64()) for x in (n_a, n_b, groups, links)), pa.array(digest, pa.string()),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs), pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times), pa.int32())),
    ]


def texts_aligned(docs: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECE_BPE) -> DataFrame:
    """Every document's figures, the digest of its groups, and its linked pairs with their times."""
    ship(docs.sparkSession)
    names = [column.split()[0] for column in _TEXTS.split(", ")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            ids, at = row.column("doc_id"), 0
            for some in batches(text or "" for text in row.column("text").to_pylist()):
                columns = _aligned(some, path_a, path_b)
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(some)), *columns], names)
                at += len(some)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _TEXTS)


def _added(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, of = np.unique(np.concatenate(pairs), return_inverse=True)
    return keys, np.bincount(of, np.concatenate(times), len(keys)).astype(np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: links per pair of ids, and whether no pair of the same second id has more."""

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        for row in rows:
            pairs.append(row.column("pairs").flatten().to_numpy())
            times.append(row.column("times").flatten().to_numpy())
            held += len(pairs[-1])
            if held > 4 * KEPT_PAIRS:
                some = _added(pairs, times)
                if len(some[0]) > KEPT_PAIRS:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, some)], ["pair", "n"])
                    some = some[0][:0], some[1][:0]
                pairs, times, held = [some[0]], [some[1]], len(some[0])
        yield pa.RecordBatch.from_arrays([*map(pa.array, _added(pairs, times))], ["pair", "n"])

    partial = aligned.select("pairs", "times").mapInArrow(add, "pair long, n long")
    counted = stage(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    second = F.shiftright("pair", _A_BITS)
    most = counted.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    return stage(
        counted.join(most, second == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")),
        "pair-counts",
    )


def _sent(aligned: DataFrame, counted: DataFrame) -> DataFrame:
    """Counts put to the documents' pairs from a table that every task holds."""
    table = counted.toArrow().sort_by("pair")
    own = {name: table.column(name).to_numpy() for name in ("pair", "n")}
    own["best"] = table.column("best").combine_chunks().to_numpy(zero_copy_only=False)
    sent = aligned.sparkSession.sparkContext.broadcast(own)

    def put(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for row in rows:
            lists = row.column("pairs")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            text = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(known["pair"], lists.flatten().to_numpy())
            times = row.column("times").flatten().to_numpy().astype(np.int64)
            best, count = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(best, text, times * known["best"][at])
            np.add.at(count, text, times * known["n"][at])
            columns = {name: row.column(name) for name in row.schema.names}
            columns |= {"n_best": pa.array(best), "count_sum": pa.array(count)}
            yield pa.RecordBatch.from_arrays([columns[name] for name in _RESULT], list(_RESULT))

    schema = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'long'}" for name in _RESULT)
    return aligned.mapInArrow(put, schema)


def _joined(aligned: DataFrame, counted: DataFrame) -> DataFrame:
    """The same by a join on the pairs, whatever their number."""
    each = aligned.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "_row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")
    )
    summed = (
        each.join(counted, "pair")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("times")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    found = aligned.join(summed, "_row", "left")
    return found.withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}).select(*_RESULT)


def cross_tokenizer(
    docs: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECE_BPE, sent_pairs: int = SENT_PAIRS
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row.

    Texts that are null, empty or not given back by the bytes of both token lists have no tokens: zeros
    and an empty digest. Repeated rows are aligned and counted one by one; null ids stay null. Other
    columns are not looked at. An empty table gives no rows.
    """
    rows = texts_aligned(docs, path_a, path_b).withColumn("_row", F.monotonically_increasing_id())
    aligned = stage(rows, "aligned")
    counted = pair_counts(aligned)
    return (_sent if counted.count() <= sent_pairs else _joined)(aligned, counted)
