"""Quantiles of groups against numpy."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexistat.operators import quantiles

SCHEMA = "g string, day date, x double, y double"


def rows():
    chance = random.Random(8)
    out = []
    for i in range(3000):
        g = chance.choice(["a", "a", "a", "b", None])
        x = chance.choice([chance.gauss(0, 1), chance.lognormvariate(0, 9), 5.0, None, math.nan])
        out.append((g, None, x, float(i % 7) if g != "b" else None))
    return out + [("one", None, 3.5, -1.0), ("far", None, math.inf, 1.0), ("far", None, -math.inf, 2.0), ("far", None, 0.0, 1e308),
                  ("far", None, 1.0, -1e308)]


@pytest.mark.parametrize("limit", [100_000, 40, 1])
def test_quantiles_of_groups_match_numpy(spark, limit):
    data = rows()
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.grouped_quantiles(spark.createDataFrame(data, SCHEMA), ["g", "day"], ["x", "y"], probabilities, limit)
    groups = defaultdict(list)
    for g, _, *values in data:
        for name, value in zip("xy", values, strict=True):
            if value is not None and not math.isnan(value):
                groups[g, name].append(value)
    found = {(r["g"], r["column"], r["probability"]): (r["n"], r["value"]) for r in got.collect()}
    assert len(found) == len(groups) * len(probabilities)
    for (g, name), values in groups.items():
        values = sorted(values)
        for p in probabilities:
            spot = (len(values) - 1) * p
            low, high = values[math.floor(spot)], values[math.ceil(spot)]
            wanted = low if low == high else low + (spot - math.floor(spot)) * (high - low)
            n, value = found[g, name, p]
            assert n == len(values) and value == pytest.approx(wanted, rel=1e-12, nan_ok=True)


def test_many_groups(spark):
    """Fences of 100,000 groups; the driver sees none of them."""
    table = spark.range(700_000).select((F.col("id") % 100_000).alias("g"), F.floor(F.col("id") / 100_000).alias("x"))
    fences = quantiles.grouped_fences(table, ["g"], ["x"])
    row = fences.agg(F.count("*"), F.min("q1"), F.max("q1"), F.min("q3"), F.max("q3"), F.max("upper")).first()
    assert tuple(row) == (100_000, 1.5, 1.5, 4.5, 4.5, 9.0)


def test_outliers_of_their_own_group_go(spark):
    data = [("a", None, float(i), None) for i in range(20)] + [("a", None, 500.0, None), ("b", None, 500.0, 1.0), (None, None, None, 2.0)]
    kept = quantiles.without_group_outliers(spark.createDataFrame(data, SCHEMA), ["g"], ["x", "y"])
    assert kept.columns == ["g", "day", "x", "y"]
    assert sorted(((r["g"], r["x"]) for r in kept.collect()), key=repr) == sorted(
        ((g, x) for g, _, x, _ in data if (g, x) != ("a", 500.0)), key=repr
    )
    empty = spark.createDataFrame([], SCHEMA)
    assert quantiles.grouped_quantiles(empty, ["g"], ["x"], [0.5]).collect() == []
    values = np.arange(9.0)
    assert quantiles.IQR_REACH * (np.quantile(values, 0.75) - np.quantile(values, 0.25)) == 6.0
