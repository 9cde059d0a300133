"""Polynomial models of the signals: fit, choose, predict, and rejection sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.functions.numeric import CENTRE, FAR_TAIL, NEAR_TAIL
from lexistat.operators import distributions, posterior, quantiles, regression
from lexistat.operators.regression import MODELS, Fit
from lexistat.plans.statistics import FILTERED_SQL, filtered, histogram_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

FINAL = "model5"
SHARE = 0.7
DRAWS = 10_000
FEW_DRAWS = 100
HASH = "((doc_id * 2654435761) % 4294967296) / 4294967296.0"


def _term_sql(term: regression.Term) -> str:
    return term[0] if term[1] == 1 else f"pow({term[0]}, {term[1]})"


def theta_sql(model: str, source: str) -> str:
    """Closed form by cofactors for up to three standardised predictors, as one row."""
    terms = [_term_sql(t) for t in MODELS[model]]
    a, b, c = (terms + [None])[:3]
    third = c is not None
    corr = (lambda x, y: f"corr({x}, {y})")
    return f"""
SELECT '{model}' AS model, {len(terms) + 1} AS k, *, ym AS t0,
       (i11 * r1 + i12 * r2 + i13 * r3) * sy AS t1, (i12 * r1 + i22 * r2 + i23 * r3) * sy AS t2,
       (i13 * r1 + i23 * r2 + i33 * r3) * sy AS t3
FROM (
  SELECT *, (1 - r23 * r23) / det AS i11, (1 - r13 * r13) / det AS i22, (1 - r12 * r12) / det AS i33,
         (r13 * r23 - r12) / det AS i12, (r12 * r23 - r13) / det AS i13, (r12 * r13 - r23) / det AS i23
  FROM (
    SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det
    FROM (
      SELECT count(*) AS n, avg(y) AS ym, stddev_samp(y) AS sy,
             avg({a}) AS m1, stddev_samp({a}) AS s1, avg({b}) AS m2, stddev_samp({b}) AS s2,
             {f'avg({c})' if third else '0.0'} AS m3, {f'stddev_samp({c})' if third else '1.0'} AS s3,
             corr({a}, {b}) AS r12, {corr(a, c) if third else '0.0'} AS r13,
             {corr(b, c) if third else '0.0'} AS r23, corr({a}, y) AS r1, corr({b}, y) AS r2,
             {corr(c, 'y') if third else '0.0'} AS r3
      FROM {source})))"""


def scaled_sql(model: str) -> list[str]:
    """Scaled predictors of a row, given the columns of a theta row."""
    return [f"(({_term_sql(t)}) - m{i}) / s{i}" for i, t in enumerate(MODELS[model], 1)]


def fitted_sql(model: str) -> str:
    return " + ".join(["t0", *(f"t{i} * {z}" for i, z in enumerate(scaled_sql(model), 1))])


FITS_SQL = f"""{FILTERED_SQL},
""" + ",\n".join(f"th_{m} AS ({theta_sql(m, 'flt')})" for m in MODELS)
ERRORS_SQL = f"""{FITS_SQL},
err AS ({' UNION ALL '.join(
    f"SELECT doc_id, model, k, y, {fitted_sql(m)} AS fitted, y - ({fitted_sql(m)}) AS residual "
    f"FROM flt, th_{m}" for m in MODELS)}),
sc AS (
  SELECT model, k, n, rss, rss / (n - 1) AS variance,
         -(n / 2.0) * ln(2 * pi()) - (n / 2.0) * ln(rss / (n - 1)) - (n - 1) / 2.0 AS loglik
  FROM (SELECT model, any_value(k) AS k, count(*) AS n, sum(residual * residual) AS rss
        FROM err GROUP BY model)),
crit AS (
  SELECT model, 'RSS' AS criterion, rss AS value, rss AS cost FROM sc
  UNION ALL SELECT model, 'Likelihood', loglik, -loglik FROM sc
  UNION ALL SELECT model, 'AIC', 2 * k - 2 * loglik, 2 * k - 2 * loglik FROM sc
  UNION ALL SELECT model, 'BIC', k * ln(n) - 2 * loglik, k * ln(n) - 2 * loglik FROM sc),
best AS (SELECT criterion, arg_min(model, cost) AS model, arg_min(value, cost) AS value
         FROM crit GROUP BY criterion)
"""


def _fitted(spark: SparkSession, folder: str) -> tuple[DataFrame, list[Fit]]:
    rows = filtered(spark, folder)
    return rows, regression.fit_models(rows)


def _final(fits: list[Fit]) -> Fit:
    return next(f for f in fits if f.model == FINAL)


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    rows, fits = _fitted(spark, folder)
    wide = regression.scaled_features(rows, _final(fits), ["doc_id"])
    names = [c for c in wide.columns if c != "doc_id"]
    return wide.unpivot(["doc_id"], names, "term", "value").select(
        "doc_id", "term", F.round("value", 6).alias("value")
    )


QUERIES["scaled_features"] = scaled_features
ORACLES["scaled_features"] = f"WITH {FITS_SQL} SELECT doc_id, 'intercept' AS term, 1.0::DOUBLE AS value FROM flt " + " ".join(
    f"UNION ALL SELECT doc_id, '{regression.term_name(t)}', round({z}, 6) + 0.0 FROM flt, th_{FINAL}"
    for t, z in zip(MODELS[FINAL], scaled_sql(FINAL))
)


def ols_theta(spark: SparkSession, folder: str) -> DataFrame:
    _, fits = _fitted(spark, folder)
    return regression.theta_table(spark, fits).withColumn("theta", F.round("theta", 6))


QUERIES["ols_theta"] = ols_theta
ORACLES["ols_theta"] = f"WITH {FITS_SQL} " + " UNION ALL ".join(
    f"SELECT model, '{name}' AS term, round(t{i}, 6) AS theta FROM th_{m}"
    for m, terms in MODELS.items()
    for i, name in enumerate(["intercept", *map(regression.term_name, terms)])
)


NEAR = 1e-7


def collinear_theta(spark: SparkSession, folder: str) -> DataFrame:
    """Two predictors that differ by a ten-millionth of a third: coefficients times that part."""
    near = filtered(spark, folder).withColumn("near", F.col("x4") + F.lit(NEAR) * F.col("x3"))
    fits = regression.fit_models(near, {"near": (("x4", 1), ("near", 1))})
    table = regression.theta_table(spark, fits)
    small = F.when(F.col("term") == "intercept", F.col("theta")).otherwise(F.col("theta") * NEAR)
    return table.select("term", F.round(small, 3).alias("theta"))


QUERIES["collinear_theta"] = collinear_theta
# y = c0 + c1 * x4 + c2 * (x4 + e * x3) is y = c0 + (c1 + c2) * x4 + c2 * e * x3, which is well conditioned.
ORACLES["collinear_theta"] = f"""
WITH {FILTERED_SQL},
s AS (SELECT avg(y) AS ym, covar_samp(x4, y) AS ay, covar_samp(x3, y) AS b_y, var_samp(x4) AS aa,
             var_samp(x3) AS bb, covar_samp(x4, x3) AS ab FROM flt),
g AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS ga, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS gb FROM s)
SELECT 'intercept' AS term, round(ym, 3) AS theta FROM g
UNION ALL SELECT 'x4', round((ga * {NEAR} - gb) * sqrt(aa), 3) FROM g
UNION ALL SELECT 'near', round(gb * sqrt(aa + 2 * {NEAR} * ab + {NEAR} * {NEAR} * bb), 3) FROM g
"""


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, fits = _fitted(spark, folder)
    return regression.model_scores(rows, fits)


def model_rss(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).select("model", "k", "n", F.round(F.col("rss") / 1e6, 6).alias("rss_m"))


QUERIES["model_rss"] = model_rss
ORACLES["model_rss"] = f"WITH {ERRORS_SQL} SELECT model, k, n, round(rss / 1e6, 6) AS rss_m FROM sc"


def model_loglik(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).select(
        "model", F.round("variance", 4).alias("variance"), F.round("loglik", 6).alias("loglik")
    )


QUERIES["model_loglik"] = model_loglik
ORACLES["model_loglik"] = f"""
WITH {ERRORS_SQL} SELECT model, round(variance, 4) AS variance, round(loglik, 6) AS loglik FROM sc
"""


def model_aic_bic(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).select(
        "model", "k", F.round("aic", 6).alias("aic"), F.round("bic", 6).alias("bic")
    )


QUERIES["model_aic_bic"] = model_aic_bic
ORACLES["model_aic_bic"] = f"""
WITH {ERRORS_SQL}
SELECT model, k, round(2 * k - 2 * loglik, 6) AS aic, round(k * ln(n) - 2 * loglik, 6) AS bic FROM sc
"""


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    long = regression.criteria(_scores(spark, folder))
    wide = regression.score_table(long, list(MODELS))
    return wide.select("criterion", *[F.round(m, 3).alias(m) for m in MODELS])


QUERIES["score_table"] = score_table
ORACLES["score_table"] = f"WITH {ERRORS_SQL} SELECT criterion, " + ", ".join(
    f"round(any_value(value) FILTER (model = '{m}'), 3) AS {m}" for m in MODELS
) + " FROM crit GROUP BY criterion"


def best_by_criterion(spark: SparkSession, folder: str) -> DataFrame:
    best = regression.best_by_criterion(regression.criteria(_scores(spark, folder)))
    return best.select("criterion", "model", F.round("value", 3).alias("value"))


QUERIES["best_by_criterion"] = best_by_criterion
ORACLES["best_by_criterion"] = f"""
WITH {ERRORS_SQL} SELECT criterion, model, round(value, 3) AS value FROM best
"""


def best_model_vote(spark: SparkSession, folder: str) -> DataFrame:
    """The model chosen by most criteria, with its coefficients."""
    rows, fits = _fitted(spark, folder)
    long = regression.criteria(regression.model_scores(rows, fits))
    winner = regression.majority_model(regression.best_by_criterion(long))
    theta = regression.theta_table(spark, fits)
    return winner.join(theta, "model").withColumn("theta", F.round("theta", 6))


QUERIES["best_model_vote"] = best_model_vote
ORACLES["best_model_vote"] = f"""WITH {ERRORS_SQL},
th AS ({' UNION ALL '.join(
    f"SELECT model, '{name}' AS term, t{i} AS theta FROM th_{m}"
    for m, terms in MODELS.items()
    for i, name in enumerate(['intercept', *map(regression.term_name, terms)]))}),
won AS (SELECT model, count(*) AS votes FROM best GROUP BY model ORDER BY votes DESC, model LIMIT 1)
SELECT model, votes, term, round(theta, 6) AS theta FROM won JOIN th USING (model)"""


def residuals(spark: SparkSession, folder: str) -> DataFrame:
    rows, fits = _fitted(spark, folder)
    errors = regression.residuals(rows, fits, ["doc_id"])
    return errors.select(
        "doc_id", "model", F.round("fitted", 6).alias("fitted"), F.round("residual", 6).alias("residual")
    )


QUERIES["residuals"] = residuals
ORACLES["residuals"] = f"""
WITH {ERRORS_SQL}
SELECT doc_id, model, round(fitted, 6) + 0.0 AS fitted, round(residual, 6) + 0.0 AS residual FROM err
"""


def _polynomial_sql(x: str, coefficients: tuple[float, ...]) -> str:
    value = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        value = f"({value} * ({x}) + {c!r}::DOUBLE)"
    return value


def normal_quantile_sql(p: str) -> str:
    def ratio(x: str, part) -> str:
        return f"{_polynomial_sql(x, part[0])} / {_polynomial_sql(x, part[1])}"

    q, r = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    return (
        f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(f'0.180625 - {q} * {q}', CENTRE)} "
        f"WHEN {r} <= 5 THEN sign({q}) * {ratio(f'{r} - 1.6', NEAR_TAIL)} "
        f"ELSE sign({q}) * {ratio(f'{r} - 5', FAR_TAIL)} END"
    )


def qq_points(spark: SparkSession, folder: str) -> DataFrame:
    rows, fits = _fitted(spark, folder)
    # Residuals that agree to nine places are equal; their order is the order of the keys.
    errors = regression.residuals(rows, fits, ["doc_id"]).withColumn("residual", F.round("residual", 9))
    points = regression.qq_points(errors, "doc_id")
    return points.select(
        "doc_id", "model", "rank", F.round("theoretical", 6).alias("theoretical"),
        F.round("sample", 6).alias("sample"),
    )


QUERIES["qq_points"] = qq_points
ORACLES["qq_points"] = f"""WITH {ERRORS_SQL},
r AS (SELECT doc_id, model, round(residual, 9) AS residual, count(*) OVER (PARTITION BY model) AS n,
             row_number() OVER (PARTITION BY model ORDER BY round(residual, 9), doc_id) AS rank FROM err),
p AS (SELECT *, (rank - CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END)
             / (n + 1 - CASE WHEN n <= 10 THEN 0.75 ELSE 1.0 END) AS p FROM r)
SELECT doc_id, model, rank, round({normal_quantile_sql('p')}, 6) + 0.0 AS theoretical,
       round(residual, 6) + 0.0 AS sample FROM p"""


def qq_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows, fits = _fitted(spark, folder)
    lines = regression.qq_lines(rows, fits)
    return lines.select(
        "model", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept")
    )


QUERIES["qq_lines"] = qq_lines
ORACLES["qq_lines"] = f"""WITH {ERRORS_SQL},
q AS (SELECT model, quantile_cont(residual, 0.25) AS q1, quantile_cont(residual, 0.75) AS q3
      FROM err GROUP BY model)
SELECT model, round((q3 - q1) / (2 * {normal_quantile_sql('0.75')}), 6) AS slope,
       round((q1 + q3) / 2, 6) AS intercept FROM q"""


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    training, test = regression.split_by_hash(filtered(spark, folder), "doc_id", SHARE)
    return training.select("doc_id", F.lit("train").alias("part")).unionByName(
        test.select("doc_id", F.lit("test").alias("part"))
    )


QUERIES["train_test_split"] = train_test_split
ORACLES["train_test_split"] = f"""
WITH {FILTERED_SQL}
SELECT doc_id, CASE WHEN {HASH} < {SHARE} THEN 'train' ELSE 'test' END AS part FROM flt
"""


def holdout_intervals(spark: SparkSession, folder: str) -> DataFrame:
    training, test = regression.split_by_hash(filtered(spark, folder), "doc_id", SHARE)
    found = regression.prediction_intervals(training, test, MODELS[FINAL], ["doc_id"])
    return found.select(
        "doc_id", "actual", *[F.round(c, 5).alias(c) for c in ("predicted", "lower", "upper")]
    )


Z1, Z2, Z3 = scaled_sql(FINAL)
QUERIES["holdout_intervals"] = holdout_intervals
ORACLES["holdout_intervals"] = f"""WITH {FILTERED_SQL},
tr AS (SELECT * FROM flt WHERE {HASH} < {SHARE}), te AS (SELECT * FROM flt WHERE NOT {HASH} < {SHARE}),
th AS ({theta_sql(FINAL, 'tr')}),
s AS (SELECT sum(pow(y - ({fitted_sql(FINAL)}), 2)) / (any_value(n) - any_value(k)) AS sigma2 FROM tr, th),
z AS (SELECT te.doc_id, te.y, th.*, {Z1} AS z1, {Z2} AS z2, {Z3} AS z3 FROM te, th),
p AS (SELECT doc_id, y, t0 + t1 * z1 + t2 * z2 + t3 * z3 AS p,
             sqrt(sigma2 * (1 + 1.0 / n + (i11 * z1 * z1 + i22 * z2 * z2 + i33 * z3 * z3
                        + 2 * i12 * z1 * z2 + 2 * i13 * z1 * z3 + 2 * i23 * z2 * z3) / (n - 1))) AS e
      FROM z, s)
SELECT doc_id, y AS actual, round(p, 5) + 0.0 AS predicted, round(p - 1.96 * e, 5) + 0.0 AS lower,
       round(p + 1.96 * e, 5) + 0.0 AS upper FROM p"""


def _draws(spark: SparkSession, folder: str, n: int) -> DataFrame:
    _, fits = _fitted(spark, folder)
    return posterior.draws(spark, _final(fits), n)


# The check scores every draw against every row.
ABC_SQL = f"""{FITS_SQL},
t AS (SELECT *, [t0, t1, t2, t3] AS t FROM th_{FINAL}),
o AS (SELECT *, list_sort(list_transform(range(1, 5), lambda i: {{'a': -abs(t[i]), 'i': i}})) AS o FROM t),
f AS (SELECT *, least(o[1].i, o[2].i) AS fa, greatest(o[1].i, o[2].i) AS fb FROM o),
d AS (SELECT i AS draw_id,
             ((i * 1664525 + 1013904223) % 4294967296) / 4294967296.0 * (2 * abs(t[fa])) - abs(t[fa]) AS theta_a,
             ((i * 22695477 + 12345) % 4294967296) / 4294967296.0 * (2 * abs(t[fb])) - abs(t[fb]) AS theta_b,
             t, fa, fb FROM f, (SELECT unnest(range(1, $draws + 1)) AS i)),
u AS (SELECT draw_id, theta_a, theta_b,
             list_transform(t, lambda v, i: CASE WHEN i = fa THEN theta_a WHEN i = fb THEN theta_b ELSE v END) AS u
      FROM d),
rows_ AS (SELECT y, {Z1} AS z1, {Z2} AS z2, {Z3} AS z3, {fitted_sql(FINAL)} AS best FROM flt, t),
eps AS (SELECT 2 * sum((y - best) ^ 2) AS eps FROM rows_),
scored AS (SELECT draw_id, any_value(theta_a) AS theta_a, any_value(theta_b) AS theta_b,
                  sum(pow(y - u[1] - u[2] * z1 - u[3] * z2 - u[4] * z3, 2)) AS rss
           FROM u, rows_ GROUP BY draw_id)
"""


def _shown(draws: DataFrame) -> DataFrame:
    return draws.select(
        "draw_id", F.round("theta_a", 6).alias("theta_a"), F.round("theta_b", 6).alias("theta_b"),
        F.round(F.col("rss") / 1e6, 6).alias("rss_m"),
    )


SHOWN_SQL = """SELECT draw_id, round(theta_a, 6) + 0.0 AS theta_a, round(theta_b, 6) + 0.0 AS theta_b,
       round(rss / 1e6, 6) AS rss_m FROM scored, eps"""


def abc_accept(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(posterior.accepted(_draws(spark, folder, DRAWS)))


QUERIES["abc_accept"] = abc_accept
ORACLES["abc_accept"] = f"WITH {ABC_SQL.replace('$draws', str(DRAWS))} {SHOWN_SQL} WHERE rss < eps"


def abc_reject(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(posterior.rejected(_draws(spark, folder, FEW_DRAWS)))


QUERIES["abc_reject"] = abc_reject
ORACLES["abc_reject"] = f"WITH {ABC_SQL.replace('$draws', str(FEW_DRAWS))} {SHOWN_SQL} WHERE rss > eps"


def abc_posterior_hist(spark: SparkSession, folder: str) -> DataFrame:
    """Marginal posteriors: the histograms of the accepted draws."""
    kept = posterior.accepted(_draws(spark, folder, DRAWS))
    bins = distributions.histogram(quantiles.long_values(kept, ["theta_a", "theta_b"]))
    return bins.select(
        "column", "bin", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"),
        "count", F.round("density", 9).alias("density"),
    )


QUERIES["abc_posterior_hist"] = abc_posterior_hist
ORACLES["abc_posterior_hist"] = histogram_sql(
    ABC_SQL.replace("$draws", str(DRAWS))
    + """, kept AS (SELECT theta_a, theta_b FROM scored, eps WHERE rss < eps),
v AS (SELECT 'theta_a' AS "column", theta_a AS value FROM kept
      UNION ALL SELECT 'theta_b', theta_b FROM kept)"""
)


def abc_joint_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Joint posterior: the accepted pairs counted on a grid."""
    kept = posterior.accepted(_draws(spark, folder, DRAWS))
    return distributions.pair_bins(kept, "theta_a", "theta_b", 10)


QUERIES["abc_joint_bins"] = abc_joint_bins
ORACLES["abc_joint_bins"] = f"""WITH {ABC_SQL.replace('$draws', str(DRAWS))},
kept AS (SELECT theta_a, theta_b FROM scored, eps WHERE rss < eps),
e AS (SELECT min(theta_a) AS x0, max(theta_a) - min(theta_a) AS dx,
             min(theta_b) AS y0, max(theta_b) - min(theta_b) AS dy FROM kept)
SELECT least(floor((theta_a - x0) / (dx / 10)), 9)::BIGINT AS x_bin,
       least(floor((theta_b - y0) / (dy / 10)), 9)::BIGINT AS y_bin, count(*) AS "count"
FROM kept, e GROUP BY ALL"""
