"""Toxicity by a classifier with a counterfactual penalty.

Features say which words, and which beginnings of longer words, a text holds. A linear model is
fitted by logistic loss; besides, every labelled text that names a group of people is scored again
with its identity terms swapped for those of another group, and so is a bounded number of the others
with a neutral mention put in, and the square of the change is penalised. What a text says about a
group then cannot weigh by the group's name, so neutral mentions are not taken for abuse.

The fit reads at most ``PER_LABEL`` documents of each label and keeps at most ``VOCABULARY``
features, those whose frequencies differ most between the labels, and the identity terms themselves. How far
frequencies are apart, in standard errors, shrinks a feature smoothly: what chance explains hardly
weighs, at any number of labels. All texts are scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lexistat.llm import labelled
from lexistat.llm.shipping import ship
from lexistat.llm.words import row_of

PER_LABEL = 6_000
VOCABULARY = 512
HALF_Z = 5.0  # a feature whose frequencies are so many standard errors apart counts half
LEAST_DOCS = 4
MENTIONS = 1_000  # texts, at most, that a neutral mention is put into
BEGINNING = 5
RIDGE = 1e-4
SWAP_PENALTY = 20.0
STEPS = 400

# Identity terms; every term is swapped for the next one of its row, the last for the first.
SWAPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("blacks", "whites", "asians", "latinos", "arabs"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrants", "natives"), ("immigrant", "native"), ("refugees", "citizens"),
    ("disabled", "deaf", "blind"), ("elderly", "young"),
)

Swaps = dict[str, str]


def swaps_of(families: Iterable[Iterable[str]]) -> Swaps:
    """Each term with the next one of its family, the last with the first."""
    listed = [[*family] for family in families]
    return {term: row[(i + 1) % len(row)] for row in listed for i, term in enumerate(row)}


def families_in(identities: DataFrame) -> list[list[str]]:
    """The families of ``identities(family, term)``, terms in order. The table is a list of names: it is read whole."""
    rows = identities.filter("term IS NOT NULL").distinct().orderBy("family", "term").collect()
    found: dict = {}
    for row in rows:
        found.setdefault(row["family"], []).append(row["term"].lower())
    return [*found.values()]

_word = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """The distinct lower-case words of a whole text; none for a null or empty one."""
    return set(_word.findall((text or "").lower()))


def traits(found: set[str]) -> set[str]:
    """The words and, as ``abcde*``, the beginnings of longer ones."""
    return found | {w[:BEGINNING] + "*" for w in found if len(w) > BEGINNING}


def swapped(found: set[str], swaps: Swaps | None = None) -> set[str] | None:
    """The words with identity terms swapped; None where there are none."""
    swaps = swaps_of(SWAPS) if swaps is None else swaps
    if found.isdisjoint(swaps):
        return None
    return {swaps.get(w, w) for w in found}


@F.pandas_udf(ArrayType(StringType()))
def _traits(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(traits(words(t))))


@dataclass(frozen=True)
class Classifier:
    bias: float
    weights: dict[str, float]
    n_pairs: int = 0  # pairs of texts whose scores were held together

    def score(self, found: set[str]) -> float:
        total = self.bias + sum(
            self.weights[t] for t in sorted(traits(found)) if t in self.weights
        )
        return float(labelled.sigmoid(np.float64(total)))


def telling(docs: DataFrame, toxic: int, clean: int, always: set[str]) -> dict[str, float]:
    """The features whose share of toxic and of clean documents differ most, and how much of each counts.

    At most ``VOCABULARY`` of them, besides those of ``always`` that occur.
    """
    seen = docs.select("label", F.explode(_traits("text")).alias("trait")).groupBy("trait").agg(
        F.sum("label").alias("ones"), F.count(F.lit(1)).alias("all")
    )
    share = F.col("all") / (toxic + clean)
    apart = F.col("ones") / toxic - (F.col("all") - F.col("ones")) / clean
    error = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    kept = seen.filter(F.col("all") >= LEAST_DOCS).select(
        "trait", F.coalesce(F.abs(apart / F.nullif(error, F.lit(0.0))), F.lit(0.0)).alias("z")
    )
    rows = kept.orderBy(F.desc("z"), "trait").limit(VOCABULARY).collect()
    # Identity terms are a list of names, so that these rows are few.
    named = kept.filter(F.col("trait").isin([*always])).collect() if always else []
    return {r["trait"]: 1 / (1 + (HALF_Z / max(r["z"], 1e-9)) ** 8) for r in (*rows, *named)}


def descend(
    x: np.ndarray, y: np.ndarray, changes: np.ndarray, penalty: float = SWAP_PENALTY
) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient steps; both labels weigh alike in all.

    ``changes`` holds feature vectors of swapped texts less those of the texts; the mean of the squared
    changes of the scores is weighed by ``penalty``.
    """
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weights, bias = np.zeros(x.shape[1]), 0.0
    ahead, bias_ahead, momentum = weights.copy(), bias, 1.0
    # The slope changes by no more than this per unit of weights.
    rough = 0.25 * float((weight * (x.sum(axis=1) + 1)).sum() + 1) + RIDGE
    if len(changes):
        rough += 2 * penalty * float((changes**2).sum() / len(changes))
    for _ in range(STEPS):
        error = weight * (labelled.sigmoid(x @ ahead + bias_ahead) - y)
        slope = x.T @ error + RIDGE * ahead
        if len(changes):
            slope += 2 * penalty * changes.T @ (changes @ ahead) / len(changes)
        before, bias_before = weights, bias
        weights, bias = ahead - slope / rough, bias_ahead - error.sum() / rough
        faster = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        pull = (momentum - 1) / faster
        ahead, bias_ahead = weights + pull * (weights - before), bias + pull * (bias - bias_before)
        momentum = faster
    return weights, bias


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, per_label: int = PER_LABEL,
    identities: DataFrame | None = None, penalty: float = SWAP_PENALTY,
) -> Classifier:
    """Learn from the labelled documents that ``usable`` admits.

    ``identities(family, term)`` names the groups of people, by default those of ``SWAPS``. Without documents
    of both labels nothing is learned and no text is toxic. Of the rows that share a labelled id one is
    read, the first in the order of their texts' hashes.
    """
    ship(docs.sparkSession)
    swaps = swaps_of(SWAPS if identities is None else families_in(identities))
    known = labelled.judged(labels, "toxic", usable)
    # At most 2 * per_label rows.
    some = docs.select("doc_id", "text").join(F.broadcast(labelled.sample(known, per_label)), "doc_id")
    chosen = some.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("r"))
    chosen = chosen.select("doc_id", "label", F.col("r.text").alias("text"))
    clean, toxic = labelled.counts(chosen)
    if not clean or not toxic:
        return Classifier(-10.0, {})
    names = telling(chosen, toxic, clean, traits(set(swaps)))
    if not names:
        return Classifier(-10.0, {})
    place = {name: i for i, name in enumerate(names)}
    mentions = sorted(swaps.items())

    def places(found: set[str]) -> list[int]:
        return sorted(place[t] for t in traits(found) if t in place)

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            have, one, other = [], [], []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = words(text)
                changed = swapped(found, swaps)
                have.append(places(found))
                if changed is None and mentions:
                    # A neutral mention: the text with one group's name and with the next one's.
                    term, instead = mentions[zlib.crc32(str(doc).encode()) % len(mentions)]
                    one.append(places(found | {term}))
                    other.append(places(found | {instead}))
                else:
                    one.append(None)
                    other.append(None if changed is None else places(changed))
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "label": batch["label"], "have": have, "one": one, "other": other}
            )

    rows = chosen.mapInPandas(
        held, "doc_id long, label int, have array<int>, one array<int>, other array<int>"
    ).collect()
    rows.sort(key=lambda r: r["doc_id"])
    counts = np.array([*names.values()], dtype=np.float32)

    def matrix(lists: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(lists), len(names)), dtype=np.float32)
        for i, have in enumerate(lists):
            out[i, have] = 1
        return out * counts

    x = matrix([r["have"] for r in rows])
    pairs = [(r["have"], r["other"]) for r in rows if r["one"] is None and r["other"] is not None]
    # A mention of either group is held to the text without it, too.
    put = [r for r in rows if r["one"] is not None][:MENTIONS]
    pairs += [pair for r in put for pair in ((r["one"], r["other"]), (r["have"], r["one"]))]
    changes = matrix([b for _, b in pairs]) - matrix([a for a, _ in pairs])
    weights, bias = descend(x, np.array([r["label"] for r in rows], dtype=np.float64), changes, penalty)
    held_weights = {n: float(w * c) for (n, c), w in zip(names.items(), weights, strict=True)}
    return Classifier(float(bias), held_weights, len(pairs))


def scores(model: Classifier) -> Column:
    """The score of the column ``text``, 0 to 1; null and empty texts get that of no words."""

    @F.pandas_udf("double")
    def value(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: model.score(words(t))).astype("float64")

    return value("text")


def judge(
    docs: DataFrame, labels: DataFrame, divisor: int = 5, held: int = 0,
    identities: DataFrame | None = None, penalty: float = SWAP_PENALTY,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Rows whose fold is ``held`` are never learned from. Repeated rows score alike; an empty table
    gives no rows. Ids without a fold (null) count as not held out; they have no labels.
    """
    fold = labelled.remainder(divisor)
    model = fit(docs, labels, fold != held, identities=identities, penalty=penalty)
    scored = docs.select(
        "doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), scores(model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, divisor: int = 5, held: int = 0) -> DataFrame:
    """The rows of ``docs`` scored below one half; same columns."""
    model = fit(docs, labels, labelled.remainder(divisor) != held)
    scored = docs.select(row_of(docs), "text").select("_row", scores(model).alias("_score"))
    return scored.filter("_score < 0.5").select("_row.*")
