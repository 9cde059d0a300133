"""Quality scores by Bradley-Terry ranking.

A document of label 1 is preferred to one of label 0. The chance that i beats j is the logistic
function of the difference of their scores, and scores are linear in features of the whole text,
so the fit is a logistic regression on feature differences without an intercept. Ranking has no
natural zero: the threshold is the quantile of the scores at the share of label 0 among all
labelled documents.

The fit reads all labelled documents. Each of the more frequent label meets ``GAMES`` of the other
one, dealt so that all of these play equally often; every step of the fit is one aggregation over the
pairs, and the quantile is that of all labelled scores. Features and scores are Spark expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexistat.llm import labelled
from lexistat.llm.words import whole_text
from lexistat.operators.ordering import global_index
from lexistat.session import stage

GAMES = 16
RIDGE = 1e-3
STEPS = 30


def features() -> list[Column]:
    """Doubles between 0 and about 1, defined for every text; the empty text gives zeros."""
    text, words = whole_text(), F.col("_words")
    length = F.greatest(F.length(text), F.lit(1))
    number = F.greatest(F.size(words), F.lit(1))
    lines = F.split(text, "\n")

    def share(pattern: str, of: Column) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / of

    return [
        F.log1p(F.size(F.array_distinct(words))) / F.log1p(number),
        F.size(F.array_distinct(lines)) / F.size(lines),
        F.sqrt(share(r"[^\p{L}\p{M}\p{N}\s.,;:'\"()-]", length)),
        F.sqrt(share(r"\p{Lu}", length)),
        share(r"\p{N}", length),
        F.least(length / number / 20, F.lit(1.0)),
        F.least(share(r"[.!?](?=\s|$)", number), F.lit(1.0)),
        share(r"(?<!\S)[^\p{L}\s]+(?!\S)", number),
        F.log1p(number) / 12,
    ]


def measured(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` and ``x``, the features of the whole text as an array."""
    words = F.regexp_extract_all(F.lower(whole_text()), F.lit(r"\S+"), F.lit(0))
    return docs.select(*keep, "text", words.alias("_words")).select(
        *keep, F.array(*[f.cast("double") for f in features()]).alias("x")
    )


@dataclass(frozen=True)
class Ranking:
    """``score = sigmoid(sharpness * (weights . x - threshold))``."""

    weights: tuple[float, ...]
    threshold: float
    sharpness: float

    def strength(self) -> Column:
        """``weights . x - threshold``."""
        total = F.lit(-self.threshold)
        for place, weight in enumerate(self.weights):
            total = total + F.lit(weight) * F.get("x", F.lit(place))
        return total


def newton(lost_and_curve, width: int, ridge: float = RIDGE) -> np.ndarray:
    """Weights by Newton steps. ``lost_and_curve(weights)`` gives the mean slope of the log-likelihood and the
    mean curvature at some weights."""
    weights = np.zeros(width)
    unit = np.eye(width) * ridge
    for _ in range(STEPS):
        slope, curve = lost_and_curve(weights)
        step = np.linalg.solve(curve + unit, slope - ridge * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def bradley_terry(better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights that explain why ``better[i]`` was preferred to ``worse[i]``."""
    difference = better - worse

    def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lost = 1.0 - labelled.sigmoid(difference @ weights)
        curve = (difference * (lost * (1 - lost))[:, None]).T @ difference
        return difference.T @ lost / len(difference), curve / len(difference)

    return newton(sums, difference.shape[1], ridge)


def cut(scores: np.ndarray, weight: np.ndarray, share: float) -> float:
    """The point below which ``share`` of the weight lies, halfway to the next score."""
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(weight[order]) / weight.sum()
    at = min(int(np.searchsorted(below, share - 1e-9)), len(order) - 2)
    return float((scores[order[at]] + scores[order[at + 1]]) / 2)


def played(known: DataFrame, low: int, high: int, games: int = GAMES) -> DataFrame:
    """``d``, the features of a document of label 1 less those of one of label 0, for every pair that meets.

    ``known(doc_id, label, x)`` holds ``low`` documents of label 0 and ``high`` of label 1. Both are numbered
    in the order of their ids' hashes; number i of the more frequent label meets the numbers i * games and on
    of the other, counted in a circle.
    """
    many, few = (1, 0) if high >= low else (0, 1)
    fewer = min(low, high)
    chance = [F.xxhash64("doc_id"), F.col("doc_id")]
    numbered = [global_index(known.where(F.col("label") == of), chance, "place", start=0) for of in (many, few)]
    turns = F.sequence(F.lit(0), F.lit(min(games, fewer) - 1))
    games_of = numbered[0].select(
        F.col("x").alias("one"), F.explode(F.transform(turns, lambda t: (F.col("place") * games + t) % fewer)).alias("place")
    )
    pairs = games_of.join(numbered[1].select("place", F.col("x").alias("other")), "place")
    sign = 1.0 if many == 1 else -1.0
    return pairs.select(F.zip_with("one", "other", lambda a, b: (a - b) * F.lit(sign)).alias("d"))


def ranked(pairs: DataFrame, scale: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """``bradley_terry`` over a table of differences ``d``, divided by ``scale``; one aggregation a step."""
    width = len(scale)
    rows = pairs.select(*[(F.get("d", F.lit(i)) / float(scale[i])).alias(f"d{i}") for i in range(width)])
    cells = [(i, j) for i in range(width) for j in range(i, width)]

    def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = sum((F.lit(float(w)) * F.col(f"d{i}") for i, w in enumerate(weights)), F.lit(0.0))
        lost = rows.withColumn("lost", 1.0 / (1.0 + F.exp(total))).withColumn("bend", F.expr("lost * (1 - lost)"))
        means = lost.agg(
            *[F.avg(F.col("lost") * F.col(f"d{i}")) for i in range(width)],
            *[F.avg(F.col("bend") * F.col(f"d{i}") * F.col(f"d{j}")) for i, j in cells],
        ).first()
        curve = np.zeros((width, width))
        for (i, j), value in zip(cells, means[width:], strict=True):
            curve[i, j] = curve[j, i] = value
        return np.array(means[:width]), curve

    return newton(sums, width, ridge)


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> Ranking:
    """Learn from the labelled documents that ``usable`` admits, all of them.

    Without documents of both labels there is nothing to rank: all scores are then 1, or 0 where
    every label is 0. Of the rows that share a labelled id one is read, the first in the order of its text's hash.
    """
    known = labelled.judged(labels, "quality", usable)
    low, high = labelled.counts(known)
    width = len(features())
    if not low or not high:
        return Ranking((0.0,) * width, 1.0 if low else -1.0, 1.0)
    # Features are measured before rows move; the texts stay.
    some = docs.select("doc_id", "text").join(known, "doc_id").withColumn("hash", F.xxhash64("text"))
    x = measured(some, F.col("doc_id"), F.col("label"), F.col("hash"))
    first = x.groupBy("doc_id", "label").agg(F.min(F.struct("hash", "x")).alias("r"))
    rows = stage(first.select("doc_id", "label", F.col("r.x").alias("x")), "measured")
    low, high = labelled.counts(rows)
    if not low or not high:
        return Ranking((0.0,) * width, 1.0 if low else -1.0, 1.0)
    spread = rows.agg(*[F.stddev_pop(F.get("x", F.lit(i))) for i in range(width)]).first()
    scale = np.array([1.0 if not s or s < 1e-9 else s for s in spread])
    weights = ranked(stage(played(rows, low, high), "pairs"), scale) / scale
    model = Ranking(tuple(weights.tolist()), 0.0, 1.0)
    scored = rows.select("doc_id", model.strength().alias("strength"))
    # Number ``low`` of all in order, and the next one.
    at = min(low, low + high - 1)
    places = global_index(scored, [F.col("strength"), F.col("doc_id")], "place")
    around = places.where(F.col("place").isin(at, at + 1)).agg(F.avg("strength")).first()[0]
    return Ranking(model.weights, around, 1.0)


def score(docs: DataFrame, model: Ranking, *keep: Column) -> DataFrame:
    """``keep`` and ``score`` for every row; null and empty texts are scored on zero features."""
    x = measured(docs, *keep)
    value = 1.0 / (1.0 + F.exp(-F.lit(model.sharpness) * model.strength()))
    return x.withColumn("score", value).drop("x")


def judge(docs: DataFrame, labels: DataFrame, divisor: int = 3, held: int = 1) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Rows whose fold is ``held`` are never learned from. Repeated rows score alike; an empty table
    gives no rows. Ids without a fold (null) count as not held out; they have no labels.
    """
    fold = labelled.remainder(divisor)
    model = fit(docs, labels, fold != held)
    return score(docs, model, F.col("doc_id"), F.coalesce(fold == held, F.lit(False)).alias("held_out")).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
