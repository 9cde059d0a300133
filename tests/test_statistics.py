import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexistat.functions.numeric import normal_quantile, pretty_width
from lexistat.operators import distributions, quantiles
from lexistat.operators.ordering import global_index
from lexistat.sources.publications import complete_cases

RNG = np.random.default_rng(7)
SAMPLES = {
    "normal": RNG.normal(100, 15, 2000),
    "hot": np.concatenate([np.full(700, 3.0), RNG.uniform(0, 10, 1300)]),
    "heavy": np.exp(RNG.normal(0, 6, 2000)),
    "whole": RNG.integers(-5, 5, 2000).astype(float),
    "constant": np.full(2000, 4.5),
}


@pytest.fixture(scope="module")
def frame(spark):
    rows = [tuple(float(SAMPLES[c][i]) for c in SAMPLES) for i in range(2000)]
    rows += [(None,) * len(SAMPLES), (float("nan"),) * len(SAMPLES)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in SAMPLES)).repartition(8)


@pytest.mark.parametrize("limit", [10, 10_000])
def test_quantiles_are_exact_whatever_the_route(frame, limit):
    found = quantiles.exact_quantiles(frame, list(SAMPLES), [0.0, 0.25, 0.5, 0.75, 1.0], limit)
    for name, values in SAMPLES.items():
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert found[(name, p)] == pytest.approx(np.quantile(values, p), rel=1e-12), (name, p)


def test_boxplot_uses_hinges(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 50.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = quantiles.boxplot_stats(df, ["x"]).first()
    assert (row["lower_hinge"], row["median"], row["upper_hinge"]) == (2.5, 4.5, 6.5)
    assert (row["lower_whisker"], row["upper_whisker"], row["outside"]) == (1.0, 7.0, 1)


def test_outliers_are_judged_on_the_unfiltered_table(spark):
    base = [(float(i % 10), float(i % 7), float(i)) for i in range(100)]
    rows = [*base, (500.0, 1.0, 1.0), (1.0, -500.0, 1.0), (1.0, 1.0, 9e9)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    kept = quantiles.without_outliers(df, ["a", "b"])
    assert kept.count() == 101
    assert kept.where("y = 9e9").count() == 1


def test_complete_cases_drop_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert complete_cases(df).count() == 1


def test_histogram_mass_is_one(frame):
    bins = distributions.histogram(quantiles.long_values(frame, list(SAMPLES))).collect()
    for name in SAMPLES:
        mine = [r for r in bins if r["column"] == name]
        assert sum(r["count"] for r in mine) == 2000
        assert sum(r["density"] * (r["right"] - r["left"]) for r in mine) == pytest.approx(1.0)


def test_histogram_classes_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    bins = distributions.histogram(quantiles.long_values(df, ["x"])).orderBy("bin").collect()
    assert [r["right"] for r in bins] == [2.0, 4.0, 6.0, 8.0, 10.0]
    assert [r["count"] for r in bins] == [3, 2, 2, 2, 2]


@pytest.mark.parametrize("low, high, classes, width", [(0, 10, 5, 2), (0, 1, 4, 0.2), (3, 97, 8, 10), (0, 7, 10, 0.5)])
def test_pretty_width(spark, low, high, classes, width):
    row = spark.range(1).select(
        pretty_width(F.lit(float(low)), F.lit(float(high)), F.lit(float(classes))).alias("w")
    ).first()
    assert row["w"] == pytest.approx(width)


def test_density_is_close_to_the_kernel_sum(frame):
    names = ["normal", "hot"]
    rows = distributions.kernel_density(quantiles.long_values(frame, names)).collect()
    for name in names:
        values, mine = SAMPLES[name], [r for r in rows if r["column"] == name]
        assert len(mine) == distributions.GRID_POINTS
        bw = mine[0]["bw"]
        q1, q3 = np.quantile(values, [0.25, 0.75])
        assert bw == pytest.approx(
            0.9 * min(values.std(ddof=1), (q3 - q1) / 1.34) * len(values) ** -0.2
        )
        x = np.array([r["x"] for r in mine])
        exact = np.exp(-0.5 * ((x[:, None] - values) / bw) ** 2).sum(1) / (
            len(values) * bw * math.sqrt(2 * math.pi)
        )
        ours = np.array([r["density"] for r in mine])
        assert np.abs(ours - exact).max() < 0.01 * exact.max()
        assert np.trapezoid(ours, x) == pytest.approx(1.0, abs=5e-3)


def test_pair_summaries(frame):
    pairs = distributions.pair_correlation(frame.dropna(), ["hot"], "normal").first()
    assert pairs["corr"] == pytest.approx(np.corrcoef(SAMPLES["hot"], SAMPLES["normal"])[0, 1])
    cells = distributions.pair_bins(frame.dropna(), "normal", "hot", 5)
    assert cells.agg(F.sum("count")).first()[0] == 2000


def test_most_frequent_value_is_the_first_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "k string")
    assert distributions.most_frequent(df, "k").first().asDict() == {"k": "a", "count": 2}


def test_normal_quantile(spark):
    ps = [1e-300, 1e-12, 0.001, 0.02425, 0.075, 0.5, 0.8, 0.975, 1 - 1e-10]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for row in df.select("p", normal_quantile(F.col("p")).alias("z")).collect():
        assert row["z"] == pytest.approx(NormalDist().inv_cdf(row["p"]), rel=1e-9, abs=1e-12)


def test_global_index_has_no_gap_under_a_hot_key(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    placed = global_index(df, [F.col("k"), F.col("id")], partitions=6).collect()
    wanted = sorted((r["k"], r["id"]) for r in placed)
    assert [(r["k"], r["id"]) for r in sorted(placed, key=lambda r: r["idx"])] == wanted
    assert sorted(r["idx"] for r in placed) == list(range(1, 3001))


def test_quantiles_end_with_infinite_values(spark):
    values = [float("inf")] * 30 + [float("-inf")] * 30 + [1.7e308, -1.7e308] + [float(i) for i in range(40)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.exact_quantiles(frame, ["x"], [0.0, 0.5, 1.0], sort_limit=5)
    assert got[("x", 0.0)] == float("-inf") and got[("x", 1.0)] == float("inf")
    assert got[("x", 0.5)] == sorted(values)[50] / 2 + sorted(values)[51] / 2


def test_correlation_over_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 100.0), (900.0, None), (float("nan"), 7.0)]
    frame = spark.createDataFrame(rows, "x double, y double")
    got = distributions.pair_correlation(frame, ["x"], "y").first()["corr"]
    assert got == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
