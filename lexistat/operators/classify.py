"""Multinomial naive Bayes on TF-IDF weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexistat.functions.text import word_terms
from lexistat.operators.regression import split_by_hash
from lexistat.operators.terms import counted_weights, homed_counts, weighted
from lexistat.session import HOME, homes, stage

SMOOTHING = 1.0
TRAINING_SHARE = 0.8


@dataclass(frozen=True)
class NaiveBayes:
    """A trained classifier; every part is a staged table.

    idf       ``(term, df, idf)`` of the training texts
    priors    ``(label, n, log_prior, unseen)``: ``unseen`` is the log-probability of a
              vocabulary term the label never had
    terms     ``(label, term, log_prob, lift)`` for the terms a label did have; ``lift`` is
              what the term adds over ``unseen``
    """

    idf: DataFrame
    priors: DataFrame
    terms: DataFrame


def train(
    docs: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id",
    terms: Column | None = None, smoothing: float = SMOOTHING,
) -> NaiveBayes:
    """Fit on ``(key, text, label)``. Class priors are not smoothed, term probabilities are."""
    terms = word_terms(F.col(text)) if terms is None else terms
    labelled = docs.select(key, text, F.col(label).alias("label")).where("label is not null")
    with_label, idf = counted_weights(labelled, terms, key, ("label",))
    sums = stage(with_label.groupBy("label", "term").agg(F.sum("w").alias("s")), "class_terms")
    size = idf.agg(F.count("*").alias("v")).scalar()
    totals = sums.groupBy("label").agg(F.sum("s").alias("total"))
    counts = labelled.groupBy("label").agg(F.count("*").alias("n"))
    everyone = labelled.agg(F.count("*").alias("n")).scalar()
    total = F.coalesce("total", F.lit(0.0))
    priors = counts.join(totals, "label", "left").select(
        "label", "n",
        F.ln(F.col("n") / everyone).alias("log_prior"),
        F.ln(F.lit(smoothing) / (total + F.lit(smoothing) * size)).alias("unseen"),
    )
    priors = stage(priors, "class_priors")
    lift = F.ln((F.col("s") + F.lit(smoothing)) / F.lit(smoothing))
    seen = sums.join(priors, "label").select(
        "label", "term", (lift + F.col("unseen")).alias("log_prob"), lift.alias("lift")
    )
    return NaiveBayes(idf, priors, stage(seen, "class_log_prob"))


def _scored(
    model: NaiveBayes, docs: DataFrame, text: str, key: str, terms: Column | None
) -> DataFrame:
    """``(key, scores)``: one ``struct<label, score>`` per label.

    A label starts with its prior and with what all known terms weigh if it had seen none of them
    (rows without a label carry that weight); the terms it has seen correct this. So the lookup
    brings the pairs that exist, with the terms' idf, to the homes of the texts; these are weighted once, and a
    document without a known term gets the priors.
    """
    if not model.priors.take(1):
        raise ValueError("the model has not been trained: no labelled document")
    terms = word_terms(F.col(text)) if terms is None else terms
    nobody = F.lit(None).cast(model.terms.schema["label"].dataType).alias("label")
    none = F.lit(None).cast("double").alias("idf")
    gains = model.terms.select("term", none, "label", "lift").unionByName(
        model.idf.select("term", "idf", nobody, F.lit(1.0).alias("lift"))
    )
    texts = docs.select(key, text)
    known = gains.repartition(homes(texts), "term").groupBy("term").agg(
        F.max("idf").alias("idf"), F.collect_list(F.struct("label", "lift")).alias("gains")
    ).where("idf is not null")
    counts, count = homed_counts(texts, terms, key, table=known)
    weights = weighted(counts, known, key, count)
    parts = (
        weights.select(HOME, key, "w", F.inline("gains"))
        .groupBy(HOME, key, "label")
        .agg(F.sum(F.col("w") * F.col("lift")).alias("part"))
        .drop(HOME)
        .unionByName(docs.select(key, nobody, F.lit(0.0).alias("part")))
    )
    # All that a document's labels have gained as one map, and what its terms weigh in all; then each label
    # takes its own entry.
    found = F.filter(
        F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "part"))), lambda p: p.isNotNull()
    )
    gained = parts.groupBy(key).agg(
        F.map_from_entries(found).alias("gained"),
        F.sum(F.when(F.col("label").isNull(), F.col("part"))).alias("weight"),
    )
    labels = model.priors.agg(
        F.collect_list(F.struct("label", "log_prior", "unseen")).alias("labels")
    ).scalar()

    def score(of: Column) -> Column:
        own = F.coalesce(F.try_element_at(F.col("gained"), of["label"]), F.lit(0.0))
        return F.struct(
            of["label"].alias("label"), (of["log_prior"] + F.col("weight") * of["unseen"] + own).alias("score")
        )

    return gained.select(key, "gained", "weight", labels.alias("labels")).select(
        key, F.transform("labels", score).alias("scores")
    )


def class_scores(
    model: NaiveBayes, docs: DataFrame, text: str = "text", key: str = "doc_id",
    terms: Column | None = None,
) -> DataFrame:
    """``(key, label, score)``: log-prior plus weighted log-probabilities, for every label."""
    return _scored(model, docs, text, key, terms).select(key, F.inline("scores"))


def predict(
    model: NaiveBayes, docs: DataFrame, text: str = "text", key: str = "doc_id",
    terms: Column | None = None,
) -> DataFrame:
    """``(key, predicted)``: the label of the best score; equal scores go to the first label."""
    ranked = F.transform(
        "scores", lambda s: F.struct((-s["score"]).alias("cost"), s["label"].alias("label"))
    )
    return _scored(model, docs, text, key, terms).select(
        key, F.array_min(ranked)["label"].alias("predicted")
    )


def train_and_test(
    docs: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id",
    share: float = TRAINING_SHARE,
) -> tuple[NaiveBayes, DataFrame]:
    """Train on a hashed share of the documents; ``(key, label, predicted)`` of the others."""
    labelled = docs.select(key, text, F.col(label).alias("label")).where("label is not null")
    training, test = split_by_hash(labelled, key, share)
    model = train(training, text, "label", key)
    predicted = predict(model, test, text, key)
    return model, test.select(key, "label").join(predicted, key)


def accuracy(judged: DataFrame) -> DataFrame:
    hit = (F.col("label") == F.col("predicted")).cast("double")
    return judged.agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def confusion(judged: DataFrame) -> DataFrame:
    return judged.groupBy("label", "predicted").agg(F.count("*").alias("count"))
