"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the fold of a document. Null ids have none."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def judged(labels: DataFrame, name: str, usable: Column) -> DataFrame:
    """``(doc_id, label)`` for ids with one agreed label of 0 or 1; null and disputed ones drop out."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1) & usable)
        .groupBy("doc_id")
        .agg(F.min(name).alias("label"), F.max(name).alias("_most"))
        .filter(F.col("label") == F.col("_most"))
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )


def sample(known: DataFrame, per_label: int) -> DataFrame:
    """At most ``per_label`` ids of each label, those with the smallest hashes: the bound of all fits."""
    chance = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.filter(F.col("label") == value).orderBy(*chance).limit(per_label) for value in (0, 1)]
    return parts[0].unionAll(parts[1])


def counts(known: DataFrame) -> tuple[int, int]:
    """How many ids of label 0 and of label 1 there are in all."""
    rows = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    return rows.get(0, 0), rows.get(1, 0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
