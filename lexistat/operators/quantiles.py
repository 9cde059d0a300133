"""Exact order statistics, and the filters and summaries that rest on them."""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexistat.session import stage

BUCKETS = 4096
SORT_LIMIT = 100_000
IQR_REACH = 1.5


@dataclass
class _Open:
    """A wanted rank, known to lie among ``size`` values between ``low`` and ``high``."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    size: int

    def holds(self, column: Column, value: Column) -> Column:
        return (column == self.column) & value.between(self.low, self.high)


def column_ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, float, float]]:
    """Count, least and greatest of the present values of each column, in one pass."""
    aggregates = []
    for c in columns:
        value = F.nanvl(F.col(c).cast("double"), F.lit(None))
        aggregates += [F.count(value), F.min(value), F.max(value)]
    row = df.agg(*aggregates).first()
    return {c: tuple(row[3 * i : 3 * i + 3]) for i, c in enumerate(columns)}


def long_values(df: DataFrame, columns: list[str], pooled: str | None = None) -> DataFrame:
    """``(column, value)`` rows of the present values; one shared name if ``pooled`` is given."""
    typed = df.select([F.col(c).cast("double").alias(c) for c in columns])
    values = typed.unpivot([], columns, "column", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    return values.withColumn("column", F.lit(pooled)) if pooled else values


def _part(value: Column, low: float, high: float) -> Column:
    """Number of the equal part of [low, high] a value falls in; always tells both ends apart.

    Infinite values have parts of their own, before and behind those of the finite ones.
    """
    least, most = max(low, -sys.float_info.max), min(high, sys.float_info.max)
    width = most / BUCKETS - least / BUCKETS
    if width == 0.0:
        part = (value >= most).cast("bigint")
    elif math.isinf(most - least):
        part = F.floor(value / width - least / width).cast("bigint")
    else:
        part = F.floor((value - least) / width).cast("bigint")
    return (
        F.when(value == math.inf, F.lit(BUCKETS + 2))
        .when(value == -math.inf, F.lit(-2))
        .otherwise(part)
    )


def _narrow(values: DataFrame, wanted: list[_Open]) -> None:
    """Cut the interval of every wanted rank to one of its BUCKETS parts.

    One scan; each task sends at most BUCKETS counts per interval, whatever the data.
    """
    spans = sorted({(w.column, w.low, w.high) for w in wanted})
    column, value = F.col("column"), F.col("value")
    span, bucket = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for i, (name, low, high) in enumerate(spans):
        inside = (column == name) & value.between(low, high)
        part = _part(value, low, high)
        span = F.when(inside, F.lit(i)).otherwise(span)
        bucket = F.when(inside, part).otherwise(bucket)
    counted = (
        values.select(span.alias("span"), bucket.alias("bucket"), "value")
        .where("span is not null")
        .groupBy("span", "bucket")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .orderBy("span", "bucket")
        .collect()
    )
    for w in wanted:
        before = (w.low, w.high, w.size)
        i, below = spans.index((w.column, w.low, w.high)), w.below
        for row in counted:
            if row["span"] != i:
                continue
            if below + row["n"] >= w.rank:
                w.low, w.high, w.below, w.size = row["low"], row["high"], below, row["n"]
                break
            below += row["n"]
        if (w.low, w.high, w.size) == before:
            raise RuntimeError(f"the values of {w.column} around rank {w.rank} cannot be told apart")


def order_statistics(
    values: DataFrame, ranks: dict[str, list[int]], ranges: dict[str, tuple[int, float, float]],
    sort_limit: int = SORT_LIMIT,
) -> dict[tuple[str, int], float]:
    """Values at the given ranks (1 = least) of each column of ``(column, value)`` rows, exact.

    Large columns are narrowed by counting, without moving rows, until at most ``sort_limit``
    values remain around a rank. Only the distinct values among those are then put in order.
    The driver holds one interval per rank.
    """
    wanted = [
        _Open(c, r, ranges[c][1], ranges[c][2], 0, ranges[c][0])
        for c in ranks
        for r in sorted(set(ranks[c]))
    ]
    while large := [w for w in wanted if w.low < w.high and w.size > sort_limit]:
        spans = _distinct_spans(large)
        _narrow(values, [w for w in large if (w.column, w.low, w.high) in spans])
    found = {(w.column, w.rank): w.low for w in wanted if w.low == w.high}
    rest = [w for w in wanted if w.low < w.high]
    if not rest:
        return found
    spans = {(w.column, w.low, w.high): w for w in rest}
    column, value = F.col("column"), F.col("value")
    numbered = [(i, w) for i, w in enumerate(spans.values())]
    labels = F.array_compact(
        F.array(*[F.when(w.holds(column, value), F.lit(i)) for i, w in numbered])
    )
    running = Window.partitionBy("span").orderBy("value")
    counted = (
        values.where(reduce(Column.__or__, [w.holds(column, value) for _, w in numbered]))
        .select(F.explode(labels).alias("span"), "value")
        .groupBy("span", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("through", F.sum("n").over(running))
    )
    keys = list(spans)
    picks = [(keys.index((w.column, w.low, w.high)), w) for w in rest]
    hit = reduce(
        Column.__or__,
        [
            (F.col("span") == i)
            & (F.col("through") >= w.rank - w.below)
            & (F.col("through") - F.col("n") < w.rank - w.below)
            for i, w in picks
        ],
    )
    rows = counted.where(hit).collect()
    for i, w in picks:
        for row in rows:
            if row["span"] == i and row["through"] - row["n"] < w.rank - w.below <= row["through"]:
                found[(w.column, w.rank)] = row["value"]
    return found


def _distinct_spans(wanted: list[_Open], at_once: int = 16) -> set[tuple[str, float, float]]:
    return set(sorted({(w.column, w.low, w.high) for w in wanted})[:at_once])


def quantiles_of(
    values: DataFrame, ranges: dict[str, tuple[int, float, float]], probabilities: list[float],
    sort_limit: int = SORT_LIMIT,
) -> dict[tuple[str, float], float]:
    """Type 7 quantiles of each column of ``(column, value)`` rows of known ranges."""
    spots = {(c, p): (ranges[c][0] - 1) * p for c in ranges for p in probabilities}
    ranks: dict[str, list[int]] = {}
    for (c, _), spot in spots.items():
        ranks.setdefault(c, []).extend([math.floor(spot) + 1, math.ceil(spot) + 1])
    found = order_statistics(values, ranks, ranges, sort_limit)
    result = {}
    for (c, p), spot in spots.items():
        low, high = found[(c, math.floor(spot) + 1)], found[(c, math.ceil(spot) + 1)]
        # Equal neighbours need no step between them; infinite ones have none.
        result[(c, p)] = low if low == high else low + (spot - math.floor(spot)) * (high - low)
    return result


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], sort_limit: int = SORT_LIMIT
) -> dict[tuple[str, float], float]:
    """Quantiles by linear interpolation between order statistics (type 7).

    A column without a value has no entry.
    """
    ranges = {c: r for c, r in column_ranges(df, columns).items() if r[0]}
    if not ranges:
        return {}
    return quantiles_of(long_values(df, list(ranges)), ranges, probabilities, sort_limit)


def iqr_fences(df: DataFrame, columns: list[str], sort_limit: int = SORT_LIMIT
               ) -> dict[str, tuple[float, float, float, float]]:
    """First and third quartile and both fences of each column, all from the same table."""
    q = exact_quantiles(df, columns, [0.25, 0.75], sort_limit)
    fences = {}
    for c in columns:
        if (c, 0.25) in q:
            q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
            reach = IQR_REACH * (q3 - q1)
            fences[c] = (q1, q3, q1 - reach, q3 + reach)
    return fences


def outlier_mask(fences: dict[str, tuple[float, float, float, float]]) -> Column:
    """True where any column lies strictly outside its fences; missing values never do."""
    outside = [
        F.coalesce((F.col(c) < low) | ((F.col(c) > high) & ~F.isnan(c)), F.lit(False))
        for c, (_, _, low, high) in fences.items()
    ]
    return reduce(Column.__or__, outside, F.lit(False))


def without_outliers(df: DataFrame, columns: list[str], sort_limit: int = SORT_LIMIT) -> DataFrame:
    """Rows with no input outside 1.5 interquartile ranges, judged on the unfiltered table."""
    return df.where(~outlier_mask(iqr_fences(df, columns, sort_limit)))


def boxplot_stats(df: DataFrame, columns: list[str], sort_limit: int = SORT_LIMIT) -> DataFrame:
    """Hinges, median, whiskers and number of outside points of each column."""
    spark = df.sparkSession
    ranges = column_ranges(df, columns)
    columns = [c for c in columns if ranges[c][0]]
    spots: dict[str, tuple[float, float, float]] = {}
    for c in columns:
        n = ranges[c][0]
        quarter = ((n + 3) // 2) / 2
        spots[c] = (quarter, (n + 1) / 2, n + 1 - quarter)
    ranks = {c: [r for s in spots[c] for r in (math.floor(s), math.ceil(s))] for c in columns}
    values = order_statistics(long_values(df, columns), ranks, ranges, sort_limit) if columns else {}
    boxes, aggregates = [], []
    for c in columns:
        hinge1, median, hinge3 = (
            0.5 * (values[(c, math.floor(s))] + values[(c, math.ceil(s))]) for s in spots[c]
        )
        reach = IQR_REACH * (hinge3 - hinge1)
        inside = F.col(c).between(hinge1 - reach, hinge3 + reach)
        kept = F.when(inside, F.col(c).cast("double"))
        boxes.append((c, ranges[c][0], hinge1, median, hinge3))
        aggregates += [F.min(kept), F.max(kept), F.count_if(~inside & ~F.isnan(F.col(c)))]
    row = df.agg(*aggregates).first() if columns else []
    rows = [(*box, *row[3 * i : 3 * i + 3]) for i, box in enumerate(boxes)]
    return spark.createDataFrame(
        rows,
        "column string, n bigint, lower_hinge double, median double, upper_hinge double, "
        "lower_whisker double, upper_whisker double, outside bigint",
    )


def _parts(value: Column, low: Column, high: Column) -> Column:
    """``_part`` for an interval in columns."""
    most = sys.float_info.max
    least, greatest = F.greatest(low, F.lit(-most)), F.least(high, F.lit(most))
    width = greatest / BUCKETS - least / BUCKETS
    far = (greatest - least) == math.inf
    part = (
        F.when(width == 0.0, (value >= greatest).cast("bigint"))
        .when(far, F.floor(value / width - least / width).cast("bigint"))
        .otherwise(F.floor((value - least) / width).cast("bigint"))
    )
    return (
        F.when(value == math.inf, F.lit(BUCKETS + 2))
        .when(value == -math.inf, F.lit(-2))
        .otherwise(part)
    )


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal keys, null keys being equal to each other."""
    return reduce(Column.__and__, [left[n].eqNullSafe(right[n]) for n in names])


def grouped_quantiles(
    df: DataFrame, groups: list[str], columns: list[str], probabilities: list[float],
    sort_limit: int = SORT_LIMIT,
) -> DataFrame:
    """``(groups, column, probability, n, value)``: exact quantiles (type 7) of each column in each group.

    Every wanted rank is a row of a table with the interval it is known to lie in. As long as an interval
    holds more than ``sort_limit`` values, it is cut into equal parts: the values are joined to their
    group's intervals and counted per part, in the tasks first, and each rank goes on with the part it falls
    in. Then the distinct values inside the intervals are put in order. The driver learns only whether
    another pass is needed, however many groups there are, and no group is gathered in one task.
    Groups are told apart null included; missing values do not count, and a group without one has no row.
    """
    keys = [f"_g{i}" for i in range(len(groups))]
    shape = [*keys, "column"]
    typed = df.select(
        *[F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)],
        *[F.col(c).cast("double").alias(c) for c in columns],
    )
    values = typed.unpivot(keys, columns, "column", "value").where("value is not null and not isnan(value)")
    ranges = values.groupBy(*shape).agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    spot = (F.col("n") - 1) * F.col("probability")
    asked = ranges.withColumn("probability", F.explode(F.array(*map(F.lit, probabilities)))).select(
        *shape, "n", "probability", "low", "high",
        F.posexplode(F.array(F.floor(spot) + 1, F.ceil(spot) + 1)).alias("side", "rank"),
    )
    ranks = stage(
        asked.select("*", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("size")), "ranks"
    )
    span = [*shape, "low", "high"]

    def inside(spans: DataFrame) -> DataFrame:
        """Values that lie in an interval of their group, once per interval."""
        joined = values.join(
            spans, _same(values, spans, shape) & values["value"].between(spans["low"], spans["high"])
        )
        return joined.select(*[spans[c] for c in span], values["value"])

    def located(ranks: DataFrame, counted: DataFrame, order: str, new: list[Column]) -> DataFrame:
        """Each rank with the counted row it falls in; rows are in ``order`` within an interval."""
        running = Window.partitionBy(*span).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        summed = counted.withColumn("through", F.sum("m").over(running)).alias("s")
        r = ranks.alias("r")
        place = F.col("r.rank") - F.col("r.below")
        fits = (place <= F.col("s.through")) & (place > F.col("s.through") - F.col("s.m"))
        same = reduce(Column.__and__, [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in span])
        kept = [F.col(f"r.{c}") for c in (*shape, "n", "probability", "side", "rank")]
        return r.join(summed, same & fits).select(*kept, *new)

    large = (F.col("low") < F.col("high")) & (F.col("size") > sort_limit)
    while not ranks.where(large).isEmpty():
        spans = ranks.where(large).select(*span).distinct()
        part = _parts(F.col("value"), F.col("low"), F.col("high")).alias("part")
        counted = inside(spans).select("*", part).groupBy(*span, "part").agg(
            F.count("*").alias("m"), F.min("value").alias("least"), F.max("value").alias("most")
        )
        cut = located(
            ranks.where(large), counted, "part",
            [F.col("s.least").alias("low"), F.col("s.most").alias("high"),
             (F.col("r.below") + F.col("s.through") - F.col("s.m")).alias("below"), F.col("s.m").alias("size")],
        )
        ranks = stage(cut.unionByName(ranks.where(~large)), "ranks")
    ready = ranks.where("low = high").withColumn("value", F.col("low"))
    rest = ranks.where("low < high")
    counted = inside(rest.select(*span).distinct()).groupBy(*span, "value").agg(F.count("*").alias("m"))
    sorted_out = located(rest, counted, "value", [F.col("s.value").alias("value")])
    found = ready.select(*sorted_out.columns).unionByName(sorted_out)
    both = found.groupBy(*shape, "n", "probability").agg(
        F.max(F.when(F.col("side") == 0, F.col("value"))).alias("low"),
        F.max(F.when(F.col("side") == 1, F.col("value"))).alias("high"),
    )
    spot = (F.col("n") - 1) * F.col("probability")
    step = (spot - F.floor(spot)) * (F.col("high") - F.col("low"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + step)
    return both.select(
        *[F.col(k).alias(g) for g, k in zip(groups, keys, strict=True)], "column", "probability", "n",
        value.alias("value"),
    )


def grouped_fences(
    df: DataFrame, groups: list[str], columns: list[str], sort_limit: int = SORT_LIMIT
) -> DataFrame:
    """``(groups, column, n, q1, q3, lower, upper)``: quartiles and fences of each column in each group."""
    quartiles = grouped_quantiles(df, groups, columns, [0.25, 0.75], sort_limit)
    sides = quartiles.groupBy(*groups, "column", "n").agg(
        F.max(F.when(F.col("probability") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("probability") == 0.75, F.col("value"))).alias("q3"),
    )
    reach = IQR_REACH * (F.col("q3") - F.col("q1"))
    return sides.select("*", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper"))


def without_group_outliers(
    df: DataFrame, groups: list[str], columns: list[str], sort_limit: int = SORT_LIMIT
) -> DataFrame:
    """Rows with no value outside the fences of their own group; missing values are inside."""
    fences = grouped_fences(df, groups, columns, sort_limit)
    # One row per group, its fences by column.
    wide = fences.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]).agg(
        F.map_from_entries(
            F.collect_list(F.struct("column", F.struct("lower", "upper")))
        ).alias("_fences")
    )
    same = reduce(Column.__and__, [df[g].eqNullSafe(wide[f"_g{i}"]) for i, g in enumerate(groups)])
    outside = F.lit(False)
    for c in columns:
        fence = F.try_element_at(F.col("_fences"), F.lit(c))
        value = F.col(c).cast("double")
        outside = outside | F.coalesce(
            ~F.isnan(value) & ((value < fence["lower"]) | (value > fence["upper"])), F.lit(False)
        )
    return df.join(wide, same, "left").where(~outside).select(*[df[c] for c in df.columns])
