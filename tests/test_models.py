import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexistat.operators import classify, posterior, regression
from lexistat.operators.regression import MODELS

RNG = np.random.default_rng(3)
N = 400
X1, X3, X4, X5 = (RNG.uniform(1, 9, N) for _ in range(4))
Y = 2 + 3 * X4 - 0.5 * X1**2 + 0.2 * X3**2 + RNG.normal(0, 1.5, N)
DATA = {"x1": X1, "x3": X3, "x4": X4, "x5": X5}


@pytest.fixture(scope="module")
def signals(spark):
    rows = [(i, *(float(DATA[c][i]) for c in DATA), float(Y[i])) for i in range(N)]
    return spark.createDataFrame(
        rows, "doc_id bigint, x1 double, x3 double, x4 double, x5 double, y double"
    )


@pytest.fixture(scope="module")
def fits(signals):
    return regression.fit_models(signals)


def design(model, rows=slice(None), center=None):
    raw = np.column_stack([DATA[c][rows] ** p for c, p in MODELS[model]])
    mean, sd = center or (raw.mean(0), raw.std(0, ddof=1))
    return np.column_stack([np.ones(len(raw)), (raw - mean) / sd]), (mean, sd)


def test_coefficients_solve_the_normal_equations(fits):
    for fit in fits:
        x, _ = design(fit.model)
        assert np.allclose(fit.theta, np.linalg.solve(x.T @ x, x.T @ Y))


def test_scores_follow_the_formulas(signals, fits):
    for row in regression.model_scores(signals, fits).collect():
        x, _ = design(row["model"])
        rss = ((Y - x @ np.linalg.lstsq(x, Y, rcond=None)[0]) ** 2).sum()
        var, k = rss / (N - 1), x.shape[1]
        log = -N / 2 * math.log(2 * math.pi) - N / 2 * math.log(var) - rss / (2 * var)
        assert row["rss"] == pytest.approx(rss)
        assert row["loglik"] == pytest.approx(log)
        assert row["aic"] == pytest.approx(2 * k - 2 * log)
        assert row["bic"] == pytest.approx(k * math.log(N) - 2 * log)


def test_moment_rss_equals_row_rss(signals, fits):
    rows = {r["model"]: r["rss"] for r in regression.model_scores(signals, fits).collect()}
    for fit in fits:
        assert posterior.least_rss(fit) == pytest.approx(rows[fit.model])


def test_residuals_sum_to_zero(signals, fits):
    sums = regression.residuals(signals, fits, ["doc_id"]).groupBy("model").agg(F.sum("residual").alias("s"))
    assert all(abs(r["s"]) < 1e-6 for r in sums.collect())


def test_dependent_predictors_have_no_coefficients(spark):
    df = spark.createDataFrame(
        [(float(i), 2.0 * i, 1.0, float(i * i)) for i in range(30)], "a double, b double, c double, y double"
    )
    fits = regression.fit_models(
        df, {"twice": (("a", 1), ("b", 1)), "flat": (("a", 1), ("c", 1)), "good": (("a", 1),)}
    )
    assert [f.theta is None for f in fits] == [True, True, False]
    thetas = regression.theta_table(spark, fits).where("theta is null").count()
    assert thetas == 6


def test_exact_relation_has_no_error(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i + 1) for i in range(50)], "a double, y double")
    fit = regression.fit_models(df, {"line": (("a", 1),)})
    assert regression.model_scores(df, fit).first()["rss"] == pytest.approx(0, abs=1e-18)


def test_votes_and_ties(spark):
    scores = [
        ("model1", "RSS", 1.0), ("model2", "RSS", 1.0), ("model1", "Likelihood", -5.0),
        ("model2", "Likelihood", -4.0), ("model1", "AIC", 3.0), ("model2", "AIC", 2.0),
        ("model1", "BIC", 1.0), ("model2", "BIC", 2.0),
    ]
    long = spark.createDataFrame(scores, "model string, criterion string, value double")
    best = regression.best_by_criterion(long)
    chosen = {r["criterion"]: r["model"] for r in best.collect()}
    assert chosen == {"RSS": "model1", "Likelihood": "model2", "AIC": "model2", "BIC": "model1"}
    assert regression.majority_model(best).first().asDict() == {"model": "model1", "votes": 2}
    wide = {r["criterion"]: r for r in regression.score_table(long, ["model1", "model2"]).collect()}
    assert wide["AIC"]["model2"] == 2.0


@pytest.mark.parametrize("n", [7, 10, 11, 40])
def test_qq_points(spark, n):
    values = RNG.normal(0, 1, n).round(1)
    rows = [(i, m, float(values[i])) for i in range(n) for m in ("a", "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, model string, residual double")
    found = regression.qq_points(df, "doc_id").where("model = 'b'").orderBy("rank").collect()
    a = 0.375 if n <= 10 else 0.5
    from statistics import NormalDist

    assert [r["rank"] for r in found] == list(range(1, n + 1))
    assert [r["sample"] for r in found] == sorted(values.tolist())
    for r in found:
        p = (r["rank"] - a) / (n + 1 - 2 * a)
        assert r["theoretical"] == pytest.approx(NormalDist().inv_cdf(p), abs=1e-9)


def test_intervals_use_the_training_scale(signals):
    train, test = regression.split_by_hash(signals, "doc_id", 0.7)
    inside = [r["doc_id"] for r in train.collect()]
    outside = [r["doc_id"] for r in test.collect()]
    assert len(inside) + len(outside) == N and not set(inside) & set(outside)
    x, scale = design("model5", inside)
    z, _ = design("model5", outside, scale)
    theta = np.linalg.solve(x.T @ x, x.T @ Y[inside])
    s2 = ((Y[inside] - x @ theta) ** 2).sum() / (len(inside) - x.shape[1])
    half = 1.96 * np.sqrt(s2 + ((z @ (s2 * np.linalg.inv(x.T @ x))) * z).sum(1))
    wanted = {i: (p, p - h, p + h) for i, p, h in zip(outside, z @ theta, half)}
    found = regression.prediction_intervals(train, test, MODELS["model5"], ["doc_id"]).collect()
    assert len(found) == len(outside)
    for r in found:
        assert (r["predicted"], r["lower"], r["upper"]) == pytest.approx(wanted[r["doc_id"]])


def test_draws_are_scored_as_rows_would(spark, fits):
    fit = next(f for f in fits if f.model == "model5")
    x, _ = design("model5")
    free = posterior.free_parameters(fit)
    assert set(free) == set(np.argsort(-np.abs(fit.theta))[:2].tolist())
    drawn = posterior.draws(spark, fit, 200)
    for r in drawn.collect():
        theta = np.array(fit.theta)
        theta[free] = (r["theta_a"], r["theta_b"])
        assert abs(r["theta_a"]) <= abs(fit.theta[free[0]])
        assert r["rss"] == pytest.approx(((Y - x @ theta) ** 2).sum())
        assert r["limit"] == pytest.approx(2 * posterior.least_rss(fit))
    kept, lost = posterior.accepted(drawn).count(), posterior.rejected(drawn).count()
    assert kept + lost == 200 and kept < 200


def test_seeded_draws_repeat_and_fill_the_prior(spark, fits):
    fit = next(f for f in fits if f.model == "model5")
    once, again = (posterior.draws(spark, fit, 3000, seed=5).collect() for _ in range(2))
    assert once == again
    size = abs(fit.theta[posterior.free_parameters(fit)[0]])
    a = np.array([r["theta_a"] for r in once])
    assert np.abs(a).max() <= size and abs(a.mean()) < 0.1 * size


@pytest.mark.parametrize("key", [0, 1, 799, 3_500_000_000, 2**40 + 12345, 2**62])
def test_split_hash_holds_for_any_key(spark, key):
    from lexistat.functions.numeric import hash_unit

    row = spark.range(key, key + 1).select(hash_unit(F.col("id")).alias("u")).first()
    assert row["u"] == (key * 2654435761 % 2**32) / 2**32


TEXTS = [
    (0, "shares fell after the bank report", "money"), (1, "the bank raised lending rates", "money"),
    (2, "profit of the bank rose", "money"), (3, "new vaccine for the virus", "health"),
    (4, "the virus spread in the clinic", "health"), (5, "clinic trials of a vaccine", "health"),
    (6, "parliament passed the bill", "law"), (7, "the bill on trade passed", "law"),
]
ASKED = [(100, "the bank and the virus virus"), (101, "parliament bill"), (102, "zzz qqq"), (103, "")]


def brute_bayes():
    import re

    def words(t):
        return Counter(re.findall(r"\w\w+", t.lower()))

    df = Counter(w for _, t, _ in TEXTS for w in words(t))
    idf = {w: math.log((1 + len(TEXTS)) / (1 + n)) + 1 for w, n in df.items()}

    def weights(t):
        w = {k: n * idf[k] for k, n in words(t).items() if k in idf}
        length = math.sqrt(sum(v * v for v in w.values()))
        return {k: v / length for k, v in w.items()} if w else {}

    labels = sorted({c for _, _, c in TEXTS})
    sums = {c: Counter() for c in labels}
    for _, t, c in TEXTS:
        for k, v in weights(t).items():
            sums[c][k] += v
    prior = Counter(c for _, _, c in TEXTS)
    result = {}
    for i, t in ASKED:
        for c in labels:
            total = sum(sums[c].values()) + len(idf)
            result[(i, c)] = math.log(prior[c] / len(TEXTS)) + sum(
                v * math.log((sums[c][k] + 1) / total) for k, v in weights(t).items()
            )
    return result


def test_naive_bayes_matches_brute_force(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string, label string")
    asked = spark.createDataFrame(ASKED, "doc_id bigint, text string")
    model = classify.train(docs)
    wanted = brute_bayes()
    found = {(r["doc_id"], r["label"]): r["score"] for r in classify.class_scores(model, asked).collect()}
    assert found.keys() == wanted.keys()
    assert all(found[k] == pytest.approx(wanted[k], abs=1e-12) for k in wanted)
    guess = {r["doc_id"]: r["predicted"] for r in classify.predict(model, asked).collect()}
    assert guess == {100: "health", 101: "law", 102: "health", 103: "health"}


def test_untrained_model_is_refused(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, label string")
    with pytest.raises(ValueError):
        classify.predict(classify.train(empty), empty)


def test_accuracy_and_confusion(spark):
    judged = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, "b", "b")], "doc_id int, label string, predicted string")
    assert classify.accuracy(judged).first()["accuracy"] == pytest.approx(2 / 3)
    assert classify.confusion(judged).where("label = 'a' and predicted = 'b'").first()["count"] == 1


def test_scores_are_taken_over_the_fitted_rows(signals):
    from pyspark.sql import functions as F

    whole = signals.withColumn("x1", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.col("x1")))
    kept = signals.where("doc_id % 5 <> 0")
    rows = [
        {r["model"]: r["rss"] for r in regression.model_scores(t, regression.fit_models(t)).collect()}
        for t in (whole, kept)
    ]
    assert rows[0] == pytest.approx(rows[1])


def test_rows_without_a_key_are_not_lost(spark):
    frame = spark.createDataFrame([(None,), (1,), (2,)], "k long")
    parts = regression.split_by_hash(frame, "k", 0.5)
    assert sum(p.count() for p in parts) == 3


def near(spark, apart, rows=400):
    chance = np.random.default_rng(2)
    a, b = chance.normal(5, 2, rows), chance.normal(0, 1, rows)
    y = 3 + 2 * a - b + chance.normal(0, 0.1, rows)
    c = a + apart * b
    data = [tuple(map(float, r)) for r in zip(a, c, y, strict=True)]
    return a, c, y, spark.createDataFrame(data, "a double, c double, y double").repartition(7)


def test_nearly_collinear_predictors_agree_with_a_decomposition(spark):
    a, c, y, table = near(spark, 1e-7)
    fit = regression.fit_models(table, {"m": (("a", 1), ("c", 1))})[0]
    assert abs(np.linalg.det(fit.correlation)) < 1e-12 and fit.theta is not None
    x = np.column_stack([np.ones(len(y)), (a - fit.means[0]) / fit.sds[0], (c - fit.means[1]) / fit.sds[1]])
    q, r = np.linalg.qr(x)
    wanted = np.linalg.solve(r, q.T @ y)
    assert np.allclose(fit.theta, wanted, rtol=1e-8, atol=0)
    rows = regression.prediction_intervals(table, table, (("a", 1), ("c", 1)), ["a"]).collect()
    assert max(abs(r["predicted"] - r["actual"]) for r in rows) < 0.6
    assert all(r["lower"] < r["predicted"] < r["upper"] for r in rows)


def test_dependent_predictors_have_no_coefficients(spark):
    _, _, _, table = near(spark, 0.0)
    assert regression.fit_models(table, {"m": (("a", 1), ("c", 1))})[0].theta is None


def test_factors_are_combined_in_a_tree(spark):
    rows = np.random.default_rng(5).normal(size=(300, 3))
    table = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double").repartition(40)
    factor = regression.tall_qr(table, [F.col(name) for name in "abc"], fan=4)
    assert np.allclose(factor.T @ factor, rows.T @ rows)
    empty = regression.tall_qr(table.where("false"), [F.col(name) for name in "abc"])
    assert empty.shape == (3, 3) and not empty.any()
