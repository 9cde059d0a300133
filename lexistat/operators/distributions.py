"""Distribution summaries: histograms, kernel densities, pair relations, frequencies."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexistat.functions.numeric import pretty_width, sturges
from lexistat.operators.quantiles import SORT_LIMIT, quantiles_of

EDGE_FUZZ = 1e-7
ROUNDING = 1e-10
GRID_POINTS = 512
GRID_CUT = 3.0
GRID_MARGIN = 4.0


def histogram(values: DataFrame) -> DataFrame:
    """Histogram of each ``column`` of ``(column, value)`` rows, on the density scale.

    Sturges' number of classes, rounded to a pretty width; classes closed on the right, the first
    also on the left. Empty classes are kept. What is joined by broadcast has one row per column,
    or one per class.
    """
    spec = (
        values.groupBy("column")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("width", pretty_width(F.col("low"), F.col("high"), sturges(F.col("n"))))
        .withColumn("first", F.floor(F.col("low") / F.col("width") + ROUNDING))
        .withColumn("last", F.ceil(F.col("high") / F.col("width") - ROUNDING))
        .withColumn(
            "first", F.col("first") - ((F.col("last") == F.col("first")) & (F.col("first") >= 0)).cast("int")
        )
        .withColumn("last", F.greatest("last", F.col("first") + 1))
        .select("column", "n", "width", "first", "last")
    )
    start = F.col("first") * F.col("width")
    place = F.ceil((F.col("value") - start) / F.col("width") - EDGE_FUZZ)
    counts = (
        values.join(F.broadcast(spec), "column")
        .groupBy("column", F.greatest(place, F.lit(1)).cast("bigint").alias("bin"))
        .agg(F.count("*").alias("n_in_bin"))
    )
    classes = spec.select(
        "*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("last") - F.col("first"))).alias("bin")
    )
    n_in_bin = F.coalesce("n_in_bin", F.lit(0))
    return classes.join(F.broadcast(counts), ["column", "bin"], "left").select(
        "column",
        "bin",
        ((F.col("first") + F.col("bin") - 1) * F.col("width")).alias("left"),
        ((F.col("first") + F.col("bin")) * F.col("width")).alias("right"),
        n_in_bin.alias("count"),
        (n_in_bin / (F.col("n") * F.col("width"))).alias("density"),
    )


def bandwidth(n: int, sd: float | None, iqr: float, first: float) -> float:
    """Rule-of-thumb bandwidth: 0.9 times the smaller spread times n to the power -1/5."""
    sd = sd or 0.0
    spread = min(sd, iqr / 1.34) or sd or abs(first) or 1.0
    return 0.9 * spread * n ** -0.2


def kernel_density(values: DataFrame, sort_limit: int = SORT_LIMIT) -> DataFrame:
    """Gaussian density of each ``column`` at 512 points that reach 3 bandwidths past the data.

    The values are first shared out linearly over 512 nodes, in one aggregation; the kernel is
    then summed over the nodes, so the cost of that part does not depend on the data. The points
    are interpolated between nodes.
    """
    spark = values.sparkSession
    stats = (
        values.groupBy("column")
        .agg(
            F.count("*").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.stddev_samp("value").alias("sd"),
        )
        .orderBy("column")
        .collect()
    )
    rows = []
    ranges = {s["column"]: (s["n"], s["low"], s["high"]) for s in stats}
    quartiles = quantiles_of(values, ranges, [0.25, 0.75], sort_limit) if stats else {}
    for s in stats:
        name = s["column"]
        iqr = quartiles[(name, 0.75)] - quartiles[(name, 0.25)]
        bw = bandwidth(s["n"], s["sd"], iqr, s["low"])
        start = s["low"] - GRID_CUT * bw
        end = s["high"] + GRID_CUT * bw
        low = start - GRID_MARGIN * bw
        step = (end - start + 2 * GRID_MARGIN * bw) / (GRID_POINTS - 1)
        rows.append((name, s["n"], bw, start, end, low, step))
    spec = spark.createDataFrame(
        rows,
        "column string, n bigint, bw double, start double, end double, low double, step double",
    )
    at = (F.col("value") - F.col("low")) / F.col("step")
    shares = (
        values.join(F.broadcast(spec), "column")
        .select("column", F.floor(at).cast("int").alias("node"), (at - F.floor(at)).alias("over"))
        .groupBy("column", "node")
        .agg(F.count("*").alias("rows"), F.sum("over").alias("over"))
    )
    parts = F.array(
        F.struct("node", (F.col("rows") - F.col("over")).alias("mass")),
        F.struct((F.col("node") + 1).alias("node"), F.col("over").alias("mass")),
    )
    nodes = (
        shares.select("column", F.inline(parts))
        .groupBy("column", "node")
        .agg(F.sum("mass").alias("mass"))
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("node", "mass"))).alias("nodes"))
    )
    scale = 1.0 / math.sqrt(2 * math.pi)

    def at_node(k):
        def add(total, node):
            u = (k - node["node"]) * F.col("step") / F.col("bw")
            return total + node["mass"] * F.exp(-0.5 * u * u)

        total = F.aggregate("nodes", F.lit(0.0), add)
        return total * F.lit(scale) / (F.col("n") * F.col("bw"))

    last = GRID_POINTS - 1
    heights = F.transform(F.sequence(F.lit(0), F.lit(last)), at_node)
    grid = spec.join(F.broadcast(nodes), "column").select(
        "column", "bw", "start", "end", "low", "step", heights.alias("heights"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("point"))
    x = F.col("start") + (F.col("end") - F.col("start")) * F.col("point") / last
    spot = (x - F.col("low")) / F.col("step")
    node = F.floor(spot).cast("int")
    left = F.get("heights", node)
    right = F.get("heights", node + 1)
    return grid.select(
        "column", "point", "bw", x.alias("x"), (left + (spot - node) * (right - left)).alias("density")
    )


def pair_correlation(df: DataFrame, inputs: list[str], output: str) -> DataFrame:
    """Correlation of each input with the output, all in one aggregation; NULL for a constant.

    Each is taken over the rows that have both values; NaN counts as missing.
    """

    def present(name: str) -> Column:
        return F.nanvl(F.col(name).cast("double"), F.lit(None))

    def corr(name: str) -> Column:
        x = F.when(present(output).isNotNull(), present(name))
        y = F.when(present(name).isNotNull(), present(output))
        return F.covar_samp(x, y) / F.nullif(F.stddev_samp(x) * F.stddev_samp(y), F.lit(0.0))

    row = df.agg(*[corr(c).alias(c) for c in inputs])
    return row.unpivot([], inputs, "column", "corr")


def pair_bins(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Counts of a scatter plot on ``bins`` by ``bins`` equal cells; empty cells left out."""
    ranges = df.agg(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
    )
    edges = F.col("edges")

    def cell(value: str, low: str, high: str):
        width = F.nullif((edges[high] - edges[low]) / bins, F.lit(0.0))
        return F.least(
            F.coalesce(F.floor((F.col(value) - edges[low]) / width), F.lit(0)), F.lit(bins - 1)
        )

    with_edges = df.select(x, y, ranges.select(F.struct("*").alias("row")).scalar().alias("edges"))
    return with_edges.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(
        cell(x, "x0", "x1").alias("x_bin"), cell(y, "y0", "y1").alias("y_bin")
    ).agg(F.count("*").alias("count"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value; of equally frequent ones the first in order."""
    counts = frequency(df, column)
    return counts.orderBy(F.desc("count"), column).limit(1)
