"""Polynomial least squares: fit, score, select, predict."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexistat.functions.numeric import hash_unit, normal_quantile
from lexistat.operators.ordering import global_index
from lexistat.operators.quantiles import SORT_LIMIT, exact_quantiles
from lexistat.session import stage

# The candidate models, as (column, power) terms; an intercept comes first in each.
MODELS: dict[str, tuple[tuple[str, int], ...]] = {
    "model1": (("x4", 1), ("x3", 2)),
    "model2": (("x4", 1), ("x3", 2), ("x5", 1)),
    "model3": (("x3", 1), ("x4", 1), ("x5", 3)),
    "model4": (("x4", 1), ("x3", 2), ("x5", 3)),
    "model5": (("x4", 1), ("x1", 2), ("x3", 2)),
}

INTERVAL_Z = 1.96
ILL_CONDITIONED = 1e8  # correlations of a larger condition number leave too few digits
FAN = 64

Term = tuple[str, int]


def term_name(term: Term) -> str:
    return term[0] if term[1] == 1 else f"{term[0]}^{term[1]}"


def term_value(term: Term) -> Column:
    """The raw polynomial feature."""
    value = F.col(term[0]).cast("double")
    return value if term[1] == 1 else F.pow(value, F.lit(float(term[1])))


@dataclass(frozen=True)
class Fit:
    """A fitted model with what is needed to scale, predict and judge new rows.

    ``theta`` is None where the predictors are linearly dependent or constant.
    """

    model: str
    terms: tuple[Term, ...]
    n: int
    y_mean: float
    y_sd: float
    means: tuple[float, ...]
    sds: tuple[float, ...]
    correlation: np.ndarray
    with_y: np.ndarray
    theta: tuple[float, ...] | None
    inverse: np.ndarray | None = None  # of the correlations, where they alone do not give it

    @property
    def parameters(self) -> int:
        return len(self.terms) + 1

    def scaled(self, i: int) -> Column:
        """Predictor ``i`` centred and divided by its sample deviation, as stored in the fit."""
        return (term_value(self.terms[i]) - F.lit(self.means[i])) / F.lit(self.sds[i])

    def predicted(self) -> Column:
        if self.theta is None:
            return F.lit(None).cast("double")
        value = F.lit(self.theta[0])
        for i in range(len(self.terms)):
            value = value + F.lit(self.theta[i + 1]) * self.scaled(i)
        return value

    def leverage(self) -> Column:
        """Quadratic form of a row in the inverse cross-product matrix of the fit."""
        inverse = np.linalg.inv(self.correlation) if self.inverse is None else self.inverse
        value = F.lit(1.0 / self.n)
        for i in range(len(self.terms)):
            for j in range(len(self.terms)):
                weight = float(inverse[i, j]) / (self.n - 1)
                value = value + F.lit(weight) * self.scaled(i) * self.scaled(j)
        return value


def complete_rows(df: DataFrame, terms: Iterable[Term], output: str) -> DataFrame:
    """The rows that have the output and all inputs of the terms; NaN counts as missing."""
    for name in sorted({t[0] for t in terms} | {output}):
        df = df.where(F.nanvl(F.col(name).cast("double"), F.lit(None)).isNotNull())
    return df


def fit_models(
    df: DataFrame, models: dict[str, tuple[Term, ...]] = MODELS, output: str = "y"
) -> list[Fit]:
    """Least squares on standardised predictors for all models from one aggregation.

    Means, deviations and covariances of the terms are taken over the table once; what reaches
    the driver is that one row, and what is solved there is one small matrix per model. Where the
    predictors are so nearly dependent that covariances would lose the digits, a second pass
    decomposes the rows themselves.
    """
    terms = sorted({t for wanted in models.values() for t in wanted})
    needed = {
        frozenset(pair) for wanted in models.values() for pair in combinations(wanted, 2)
    }
    pairs = sorted(tuple(sorted(p)) for p in needed)
    y = F.col(output).cast("double")
    row = complete_rows(df, terms, output).agg(
        F.count("*"), F.avg(y), F.stddev_samp(y),
        *[F.avg(term_value(t)) for t in terms],
        *[F.stddev_samp(term_value(t)) for t in terms],
        *[F.covar_samp(term_value(t), y) for t in terms],
        *[F.covar_samp(term_value(a), term_value(b)) for a, b in pairs],
    ).first()
    n, y_mean, y_sd = row[0], row[1], row[2]
    unsolved: list[int] = []
    m = len(terms)
    mean = dict(zip(terms, row[3 : 3 + m]))
    sd = dict(zip(terms, row[3 + m : 3 + 2 * m]))
    r_y = {t: _ratio(v, sd[t], y_sd) for t, v in zip(terms, row[3 + 2 * m : 3 + 3 * m])}
    r = {frozenset(p): _ratio(v, *(sd[t] for t in p)) for p, v in zip(pairs, row[3 + 3 * m :])}
    fits = []
    for name, wanted in models.items():
        k = len(wanted)
        matrix = np.array(
            [
                [1.0 if i == j else r[frozenset((wanted[i], wanted[j]))] for j in range(k)]
                for i in range(k)
            ]
        )
        vector = np.array([r_y[t] for t in wanted])
        known = np.isfinite(matrix).all() and np.isfinite(vector).all() and n > k + 1
        theta = None
        if known and np.linalg.cond(matrix) <= ILL_CONDITIONED:
            theta = (y_mean, *(float(b) for b in np.linalg.solve(matrix, vector) * y_sd))
        elif known:
            unsolved.append(len(fits))
        fits.append(
            Fit(
                name, tuple(wanted), n, y_mean, y_sd, tuple(mean[t] for t in wanted),
                tuple(sd[t] for t in wanted), matrix, vector, theta,
            )
        )
    if unsolved:
        again = [fits[i] for i in unsolved]
        scaled = {t: f.scaled(i) for f in again for i, t in enumerate(f.terms)}
        columns = [F.lit(1.0), *scaled.values(), y]
        factor = tall_qr(complete_rows(df, terms, output), columns)
        for i, fit in zip(unsolved, again, strict=True):
            places = [0, *(1 + [*scaled].index(t) for t in fit.terms)]
            fits[i] = replace(fit, **solved(factor[:, places], factor[:, -1], fit.n))
    return fits


def solved(x: np.ndarray, y: np.ndarray, n: int) -> dict:
    """Coefficients and inverse correlations from the columns of a triangular factor; none below full rank."""
    left, sizes, right = np.linalg.svd(x, full_matrices=False)
    if sizes[-1] <= sizes[0] * max(x.shape) * np.finfo(float).eps:
        return {"theta": None}
    theta = right.T @ ((left.T @ y) / sizes)
    inverse = (right.T / sizes**2) @ right * (n - 1)
    return {"theta": tuple(map(float, theta)), "inverse": inverse[1:, 1:]}


def tall_qr(df: DataFrame, columns: list[Column], fan: int = FAN) -> np.ndarray:
    """The triangular factor R of a QR decomposition of the rows, up to signs of its own rows.

    Every task reduces its rows to one factor, batch by batch, and factors are reduced ``fan`` at a time
    until so many are left, which the driver reduces. A factor has one row per column, whatever the table.
    """
    width = len(columns)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, width))
        for batch in batches:
            rows = batch.column("x").flatten().to_numpy().reshape(-1, width)
            factor = np.linalg.qr(np.concatenate([factor, rows]), mode="r")
        if len(factor):
            yield pa.RecordBatch.from_arrays([pa.array(factor.tolist(), pa.list_(pa.float64()))], ["x"])

    rows = df.select(F.array(*[c.cast("double") for c in columns]).alias("x"))
    factors = stage(rows.mapInArrow(reduced, "x array<double>"), "factors")
    while (left := factors.count()) > fan * width:
        parts = -(-left // (fan * width))
        factors = stage(factors.repartition(parts).mapInArrow(reduced, "x array<double>"), "factors")
    last = np.array([row["x"] for row in factors.collect()]).reshape(-1, width)
    factor = np.linalg.qr(last, mode="r")
    return np.concatenate([factor, np.zeros((width - len(factor), width))])


def _ratio(covariance: float | None, sd_a: float | None, sd_b: float | None) -> float:
    """Correlation, NaN where it is not defined (a constant column, too few rows)."""
    return covariance / (sd_a * sd_b) if covariance is not None and sd_a and sd_b else float("nan")


def scaled_features(df: DataFrame, fit: Fit, keys: list[str]) -> DataFrame:
    """The design row of a model: intercept and scaled predictors."""
    names = [term_name(t) for t in fit.terms]
    return df.select(
        *keys, F.lit(1.0).alias("intercept"),
        *[fit.scaled(i).alias(name) for i, name in enumerate(names)],
    )


def theta_table(spark: SparkSession, fits: list[Fit]) -> DataFrame:
    """Coefficients as ``(model, term, theta)``."""
    rows = []
    for fit in fits:
        names = ["intercept", *(term_name(t) for t in fit.terms)]
        theta = fit.theta or (None,) * len(names)
        rows += [(fit.model, name, value) for name, value in zip(names, theta)]
    return spark.createDataFrame(rows, "model string, term string, theta double")


def model_scores(df: DataFrame, fits: list[Fit], output: str = "y") -> DataFrame:
    """RSS, variance, log-likelihood, AIC and BIC of each model: one pass for all of them.

    The parameter count ``k`` includes the intercept. The rows are those the models were fitted on:
    complete in all of their terms. Models without coefficients have no row.
    """
    fitted = [f for f in fits if f.theta is not None]
    if not fitted:
        return df.sparkSession.createDataFrame(
            [], "model string, rss double, k int, n bigint, variance double, loglik double, aic double, bic double"
        )
    sums = complete_rows(df, [t for f in fits for t in f.terms], output).agg(
        *[F.sum(F.pow(F.col(output) - f.predicted(), F.lit(2.0))).alias(f.model) for f in fitted]
    )
    names = [f.model for f in fitted]
    facts = F.create_map(*[F.lit(v) for f in fitted for v in (f.model, f.parameters)])
    size = F.lit(float(fitted[0].n))
    rss, k = F.col("rss"), F.col("k")
    two_pi = F.lit(float(2 * np.pi))
    return (
        sums.unpivot([], names, "model", "rss")
        .withColumn("k", facts[F.col("model")])
        .withColumn("n", size.cast("bigint"))
        .withColumn("variance", rss / (size - 1))
        .withColumn(
            "loglik",
            -(size / 2) * F.ln(two_pi)
            - (size / 2) * F.ln("variance")
            - rss / (2 * F.col("variance")),
        )
        .withColumn("aic", 2.0 * k - 2 * F.col("loglik"))
        .withColumn("bic", k * F.ln(size) - 2 * F.col("loglik"))
    )


def criteria(scores: DataFrame) -> DataFrame:
    """Scores as ``(model, criterion, value)``."""
    return scores.select(
        "model", F.col("rss").alias("RSS"), F.col("loglik").alias("Likelihood"),
        F.col("aic").alias("AIC"), F.col("bic").alias("BIC"),
    ).unpivot(["model"], ["RSS", "Likelihood", "AIC", "BIC"], "criterion", "value")


def score_table(long: DataFrame, models: list[str]) -> DataFrame:
    """One row per criterion, one column per model."""
    return long.groupBy("criterion").pivot("model", models).agg(F.first("value"))


def best_by_criterion(long: DataFrame) -> DataFrame:
    """Least RSS, AIC and BIC, greatest likelihood; ties go to the lowest model."""
    cost = F.when(F.col("criterion") == "Likelihood", -F.col("value")).otherwise(F.col("value"))
    best = F.min(F.struct(cost.alias("cost"), F.col("model"), F.col("value")))
    return long.groupBy("criterion").agg(best.alias("best")).select(
        "criterion", F.col("best.model").alias("model"), F.col("best.value").alias("value")
    )


def majority_model(best: DataFrame) -> DataFrame:
    """The model most criteria choose, with its votes; ties go to the first in order."""
    votes = best.groupBy("model").agg(F.count("*").alias("votes"))
    return votes.orderBy(F.desc("votes"), "model").limit(1)


def residuals(df: DataFrame, fits: list[Fit], keys: list[str], output: str = "y") -> DataFrame:
    """``(keys, model, fitted, residual)`` for every row and model, in one map pass."""
    each = F.array(
        *[
            F.struct(F.lit(f.model).alias("model"), f.predicted().alias("fitted"))
            for f in fits
        ]
    )
    return df.select(*keys, output, F.inline(each)).select(
        *keys, "model", "fitted", (F.col(output) - F.col("fitted")).alias("residual")
    )


def qq_points(
    errors: DataFrame, key: str, group: str = "model", value: str = "residual"
) -> DataFrame:
    """Points of a normal quantile plot per group: sample value against normal quantile.

    Equal values are ordered by ``key``. One range sort serves all groups; a group's ranks start
    after the rows of the groups before it. The groups are models: one broadcast row for each.
    """
    order = [F.col(group), F.col(value), F.col(key)]
    placed = global_index(errors.where(F.col(value).isNotNull()), order, "_place")
    groups = placed.groupBy(group).agg(
        F.count("*").alias("_n"), F.min("_place").alias("_first")
    )
    rank = F.col("_place") - F.col("_first") + 1
    offset = F.when(F.col("_n") <= 10, F.lit(0.375)).otherwise(F.lit(0.5))
    p = (rank - offset) / (F.col("_n") + 1 - 2 * offset)
    return placed.join(F.broadcast(groups), group).select(
        group, key, rank.alias("rank"), normal_quantile(p).alias("theoretical"),
        F.col(value).alias("sample"),
    )


def qq_lines(
    df: DataFrame, fits: list[Fit], output: str = "y", sort_limit: int = SORT_LIMIT
) -> DataFrame:
    """Line of each normal quantile plot, through the quartiles of both axes."""
    spark = df.sparkSession
    names = [f.model for f in fits]
    wide = df.select(*[(F.col(output) - f.predicted()).alias(f.model) for f in fits])
    q = exact_quantiles(wide, names, [0.25, 0.75], sort_limit)
    quartile = normal_quantile(F.lit(0.75))
    rows = [(m, q.get((m, 0.25)), q.get((m, 0.75))) for m in names]
    slope = (F.col("q3") - F.col("q1")) / (2 * quartile)
    return spark.createDataFrame(rows, "model string, q1 double, q3 double").select(
        "model", slope.alias("slope"), ((F.col("q1") + F.col("q3")) / 2).alias("intercept")
    )


def split_by_hash(df: DataFrame, key: str, share: float) -> tuple[DataFrame, DataFrame]:
    """Training and test rows: a map-only split fixed by an integer key; without a key to the test."""
    training = F.coalesce(hash_unit(F.col(key)) < F.lit(share), F.lit(False))
    return df.where(training), df.where(~training)


def prediction_intervals(
    train: DataFrame, test: DataFrame, terms: tuple[Term, ...], keys: list[str], output: str = "y"
) -> DataFrame:
    """Predictions of a model fitted on ``train`` for the rows of ``test``, with 95 % intervals.

    The test rows are scaled with the training means and deviations.
    """
    fit = fit_models(train, {"model": terms}, output)[0]
    if fit.theta is None:
        raise ValueError("the predictors are linearly dependent on the training rows")
    complete = complete_rows(train, terms, output)
    rss = complete.agg(F.sum(F.pow(F.col(output) - fit.predicted(), F.lit(2.0)))).first()[0]
    sigma2 = rss / (fit.n - fit.parameters)
    error = F.sqrt(F.lit(sigma2) * (1 + fit.leverage()))
    predicted = fit.predicted()
    return test.select(
        *keys, F.col(output).alias("actual"), predicted.alias("predicted"),
        (predicted - INTERVAL_Z * error).alias("lower"),
        (predicted + INTERVAL_Z * error).alias("upper"),
    )
