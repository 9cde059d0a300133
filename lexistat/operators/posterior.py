"""Approximate Bayesian computation by rejection for a fitted linear model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions.numeric import draw_unit
from lexistat.operators.regression import Fit

TOLERANCE = 2.0
FREE_PARAMETERS = 2


def free_parameters(fit: Fit) -> list[int]:
    """Positions of the two coefficients largest in size, in model order; the rest stay fixed."""
    ranked = sorted(range(len(fit.theta)), key=lambda i: (-abs(fit.theta[i]), i))
    return sorted(ranked[:FREE_PARAMETERS])


def rss_at(fit: Fit, theta: list[Column]) -> Column:
    """RSS of the fit's table at any coefficients, from its moments alone."""
    spread = (fit.n - 1) * fit.y_sd
    value = F.lit(spread * fit.y_sd) + F.lit(float(fit.n)) * F.pow(
        F.lit(fit.y_mean) - theta[0], F.lit(2.0)
    )
    for i in range(len(fit.terms)):
        value = value - F.lit(2 * spread * float(fit.with_y[i])) * theta[i + 1]
        for j in range(len(fit.terms)):
            weight = (fit.n - 1) * float(fit.correlation[i, j])
            value = value + F.lit(weight) * theta[i + 1] * theta[j + 1]
    return value


def least_rss(fit: Fit) -> float:
    """RSS at the fitted coefficients."""
    explained = float(fit.with_y @ np.linalg.solve(fit.correlation, fit.with_y))
    return (fit.n - 1) * fit.y_sd**2 * (1 - explained)


def draws(
    spark: SparkSession, fit: Fit, n: int, rss: float | None = None, seed: int | None = None
) -> DataFrame:
    """``n`` draws of the free coefficients, uniform within their own size, with RSS and limit.

    Each draw is scored from the moments, so the draws never meet the rows. Without a seed the
    draws come from a fixed sequence that any engine can repeat; with one, from Spark's generator.
    """
    if fit.theta is None:
        raise ValueError("the model has no coefficients")
    first, second = free_parameters(fit)
    limit = TOLERANCE * (least_rss(fit) if rss is None else rss)

    def drawn_value(stream: int, parameter: int) -> Column:
        size = abs(fit.theta[parameter])
        unit = draw_unit(F.col("id"), stream) if seed is None else F.rand(seed + stream)
        return unit * F.lit(2 * size) - F.lit(size)

    drawn = spark.range(1, n + 1).select(
        F.col("id").alias("draw_id"),
        drawn_value(0, first).alias("theta_a"),
        drawn_value(1, second).alias("theta_b"),
    )
    theta = [F.lit(value) for value in fit.theta]
    theta[first], theta[second] = F.col("theta_a"), F.col("theta_b")
    return drawn.withColumn("rss", rss_at(fit, theta)).withColumn("limit", F.lit(limit))


def accepted(drawn: DataFrame) -> DataFrame:
    return drawn.where(F.col("rss") < F.col("limit"))


def rejected(drawn: DataFrame) -> DataFrame:
    return drawn.where(F.col("rss") > F.col("limit"))
