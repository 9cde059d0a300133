"""Missing values, outliers and distribution summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.operators import distributions, quantiles
from lexistat.operators.ordering import global_index
from lexistat.sources.publications import SIGNAL_INPUTS, complete_cases
from lexistat.sources.tables import signals, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

INPUTS = list(SIGNAL_INPUTS)
COLUMNS = [*INPUTS, "y"]
PRICES = ["l_quantity", "l_extendedprice", "l_discount"]
CELLS = 10

# Signals measured on the texts, and those that pass the filter: sig, flt.
SIGNALS_SQL = r"""
sig AS (
  SELECT doc_id, n_chars::DOUBLE AS x1, length(text)::DOUBLE / greatest(len(ws), 1) AS x3,
         len(string_split(text, chr(10)))::DOUBLE AS x4,
         length(regexp_replace(text, '[^,]', '', 'g'))::DOUBLE AS x5,
         len(list_distinct(ws))::DOUBLE AS y
  FROM (SELECT *, list_filter(string_split_regex(lower(text), '[ \t\n\r]+'), lambda w: w <> '') AS ws
        FROM documents))
"""


def fences_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 "
        f"FROM {source}"
        for c in columns
    )


INSIDE = " AND ".join(
    f"{c} BETWEEN (SELECT q1 - 1.5 * (q3 - q1) FROM fen WHERE \"column\" = '{c}') "
    f"AND (SELECT q3 + 1.5 * (q3 - q1) FROM fen WHERE \"column\" = '{c}')"
    for c in INPUTS
)
FILTERED_SQL = f"""{SIGNALS_SQL},
fen AS ({fences_sql(INPUTS, 'sig')}),
flt AS (SELECT * FROM sig WHERE {INSIDE})"""


def long_sql(columns: list[str], source: str, name: str | None = None) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name or c}' AS \"column\", {c}::DOUBLE AS value FROM {source}" for c in columns
    )


def filtered(spark: SparkSession, folder: str) -> DataFrame:
    return quantiles.without_outliers(signals(spark, folder), INPUTS)


def signals_table(spark: SparkSession, folder: str) -> DataFrame:
    return signals(spark, folder).withColumn("x3", F.round("x3", 6))


QUERIES["signals_table"] = signals_table
ORACLES["signals_table"] = f"""
WITH {SIGNALS_SQL} SELECT doc_id, x1, round(x3, 6) AS x3, x4, x5, y FROM sig
"""


def complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Signals with a comma count of 0 read as missing and a one-line text as NaN."""
    sig = signals(spark, folder).select(
        "doc_id", F.nullif("x5", F.lit(0.0)).alias("x5"),
        F.when(F.col("x4") == 1, F.lit(float("nan"))).otherwise(F.col("x4")).alias("x4"),
    )
    return complete_cases(sig)


QUERIES["complete_cases"] = complete_rows
ORACLES["complete_cases"] = f"WITH {SIGNALS_SQL} SELECT doc_id, x4, x5 FROM sig WHERE x5 <> 0 AND x4 <> 1"


def column_summary(spark: SparkSession, folder: str) -> DataFrame:
    values = quantiles.long_values(signals(spark, folder), COLUMNS)
    v = F.col("value")
    return values.groupBy("column").agg(
        F.count(v).alias("n"), F.round(F.sum(v), 4).alias("total"), F.round(F.avg(v), 6).alias("mean"),
        F.round(F.stddev_samp(v), 6).alias("sd"), F.round(F.min(v), 6).alias("low"),
        F.round(F.max(v), 6).alias("high"),
    )


QUERIES["column_summary"] = column_summary
ORACLES["column_summary"] = f"""
WITH {SIGNALS_SQL}, v AS ({long_sql(COLUMNS, 'sig')})
SELECT "column", count(value) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS sd, round(min(value), 6) AS low, round(max(value), 6) AS high
FROM v GROUP BY "column"
"""


def _fences(spark: SparkSession, df: DataFrame, columns: list[str]) -> DataFrame:
    rows = [(c, *f) for c, f in quantiles.iqr_fences(df, columns).items()]
    table_ = spark.createDataFrame(rows, "column string, q1 double, q3 double, low double, high double")
    return table_.select("column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "low", "high")])


FENCE_COLUMNS = """SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
       round(q1 - 1.5 * (q3 - q1), 6) AS low, round(q3 + 1.5 * (q3 - q1), 6) AS high FROM fen"""


def iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _fences(spark, signals(spark, folder), INPUTS)


QUERIES["iqr_bounds"] = iqr_bounds
ORACLES["iqr_bounds"] = f"WITH {FILTERED_SQL} {FENCE_COLUMNS}"


def lineitem_iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _fences(spark, table(spark, folder, "lineitem").select(*PRICES), PRICES)


QUERIES["lineitem_iqr_bounds"] = lineitem_iqr_bounds
ORACLES["lineitem_iqr_bounds"] = f"WITH fen AS ({fences_sql(PRICES, 'lineitem')}) {FENCE_COLUMNS}"


def iqr_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return filtered(spark, folder).withColumn("x3", F.round("x3", 6))


QUERIES["iqr_filtered"] = iqr_filtered
ORACLES["iqr_filtered"] = f"""
WITH {FILTERED_SQL} SELECT doc_id, x1, round(x3, 6) AS x3, x4, x5, y FROM flt
"""


def boxplot_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", n, h1, med, h3,
  (SELECT min({c}) FROM {source} WHERE {c} BETWEEN h1 - 1.5 * (h3 - h1) AND h3 + 1.5 * (h3 - h1)) AS w1,
  (SELECT max({c}) FROM {source} WHERE {c} BETWEEN h1 - 1.5 * (h3 - h1) AND h3 + 1.5 * (h3 - h1)) AS w3,
  (SELECT count(*) FROM {source} WHERE {c} < h1 - 1.5 * (h3 - h1) OR {c} > h3 + 1.5 * (h3 - h1)) AS o
FROM (SELECT n, 0.5 * (s[floor(q)::INT] + s[ceil(q)::INT]) AS h1,
             0.5 * (s[((n + 1) // 2)::INT] + s[((n + 2) // 2)::INT]) AS med,
             0.5 * (s[floor(n + 1 - q)::INT] + s[ceil(n + 1 - q)::INT]) AS h3
      FROM (SELECT list_sort(list({c}::DOUBLE)) AS s, count(*) AS n, ((count(*) + 3) // 2) / 2 AS q
            FROM {source}))"""
        for c in columns
    )


BOX_COLUMNS = """SELECT "column", n, round(h1, 6) AS lower_hinge, round(med, 6) AS median,
       round(h3, 6) AS upper_hinge, round(w1, 6) AS lower_whisker, round(w3, 6) AS upper_whisker,
       o AS outside FROM box"""


def _boxes(df: DataFrame, columns: list[str]) -> DataFrame:
    box = quantiles.boxplot_stats(df, columns)
    parts = ("lower_hinge", "median", "upper_hinge", "lower_whisker", "upper_whisker")
    return box.select("column", "n", *[F.round(c, 6).alias(c) for c in parts], "outside")


def boxplot_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _boxes(signals(spark, folder), COLUMNS)


QUERIES["boxplot_stats"] = boxplot_stats
ORACLES["boxplot_stats"] = (
    f"WITH {SIGNALS_SQL}, box AS ({boxplot_sql(COLUMNS, 'sig')}) {BOX_COLUMNS}"
)


def lineitem_boxplot(spark: SparkSession, folder: str) -> DataFrame:
    return _boxes(table(spark, folder, "lineitem").select(*PRICES), PRICES)


QUERIES["lineitem_boxplot"] = lineitem_boxplot
ORACLES["lineitem_boxplot"] = f"WITH box AS ({boxplot_sql(PRICES, 'lineitem')}) {BOX_COLUMNS}"


def histogram_sql(values: str) -> str:
    """Histogram of v("column", value); ``values`` defines v."""
    return f"""WITH {values},
h0 AS (SELECT "column", count(*) AS n, min(value) AS lo, max(value) AS hi,
              (max(value) - min(value)) / ceil(log2(count(*)) + 1) AS cell FROM v GROUP BY "column"),
h1 AS (SELECT *, 10.0 ^ floor(log10(cell)) AS base FROM h0),
h2 AS (SELECT *, CASE WHEN 10 * base - cell < 1.5 * (cell - 5 * base) THEN 10 * base
                      WHEN 5 * base - cell < 2.75 * (cell - 2 * base) THEN 5 * base
                      WHEN 2 * base - cell < 1.5 * (cell - base) THEN 2 * base ELSE base END AS wd FROM h1),
h3 AS (SELECT *, floor(lo / wd + 1e-10) AS f, ceil(hi / wd - 1e-10) AS l FROM h2),
cls AS (SELECT "column", n, wd, f, unnest(range(1, (l - f)::BIGINT + 1)) AS bin FROM h3),
cnt AS (SELECT "column", greatest(ceil((value - f * wd) / wd - 1e-7), 1)::BIGINT AS bin, count(*) AS c
        FROM v JOIN h3 USING ("column") GROUP BY ALL)
SELECT "column", bin, round((f + bin - 1) * wd, 6) AS "left", round((f + bin) * wd, 6) AS "right",
       coalesce(c, 0) AS "count", round(coalesce(c, 0) / (n * wd), 9) AS density
FROM cls LEFT JOIN cnt USING ("column", bin)"""


def _histogram(values: DataFrame) -> DataFrame:
    return distributions.histogram(values).select(
        "column", "bin", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"),
        "count", F.round("density", 9).alias("density"),
    )


def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _histogram(quantiles.long_values(filtered(spark, folder), COLUMNS))


QUERIES["histogram"] = histogram
ORACLES["histogram"] = histogram_sql(f"{FILTERED_SQL}, v AS ({long_sql(COLUMNS, 'flt')})")


def pooled_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _histogram(quantiles.long_values(filtered(spark, folder), INPUTS, "X"))


QUERIES["pooled_histogram"] = pooled_histogram
ORACLES["pooled_histogram"] = histogram_sql(f"{FILTERED_SQL}, v AS ({long_sql(INPUTS, 'flt', 'X')})")


def lineitem_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _histogram(quantiles.long_values(table(spark, folder, "lineitem"), PRICES))


QUERIES["lineitem_histogram"] = lineitem_histogram
ORACLES["lineitem_histogram"] = histogram_sql(f"v AS ({long_sql(PRICES, 'lineitem')})")


def density_sql(values: str) -> str:
    """Binned kernel density of v("column", value); ``values`` defines v."""
    return f"""WITH {values},
d0 AS (SELECT "column", count(*) AS n, min(value) AS mn, max(value) AS mx,
              0.9 * least(stddev_samp(value),
                (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34) * count(*) ^ (-0.2) AS bw
       FROM v GROUP BY "column"),
d1 AS (SELECT *, mn - 3 * bw AS s, mx + 3 * bw AS e, mn - 7 * bw AS lo,
              (mx - mn + 14 * bw) / 511 AS step FROM d0),
b AS (SELECT "column", floor((value - lo) / step)::INT AS node,
             (value - lo) / step - floor((value - lo) / step) AS over FROM v JOIN d1 USING ("column")),
m AS (SELECT "column", node, sum(mass) AS mass FROM (
        SELECT "column", node, 1 - over AS mass FROM b
        UNION ALL SELECT "column", node + 1, over FROM b) GROUP BY ALL),
k AS (SELECT "column", g.i AS k, sum(mass * exp(-0.5 * ((g.i - node) * step / bw) ^ 2))
             / sqrt(2 * pi()) / any_value(n * bw) AS h
      FROM m JOIN d1 USING ("column"), (SELECT unnest(range(0, 512)) AS i) g GROUP BY ALL),
p AS (SELECT d1.*, g.i AS point, s + (e - s) * g.i / 511 AS x,
             (s + (e - s) * g.i / 511 - lo) / step AS spot
      FROM d1, (SELECT unnest(range(0, 512)) AS i) g)
SELECT p."column", point::INT AS point, round(bw, 6) AS bw, round(x, 6) AS x,
       round(l.h + (spot - floor(spot)) * (r.h - l.h), 9) AS density
FROM p JOIN k l ON l."column" = p."column" AND l.k = floor(spot)
       JOIN k r ON r."column" = p."column" AND r.k = floor(spot) + 1"""


def _density(values: DataFrame) -> DataFrame:
    return distributions.kernel_density(values).select(
        "column", "point", F.round("bw", 6).alias("bw"), F.round("x", 6).alias("x"),
        F.round("density", 9).alias("density"),
    )


def kde(spark: SparkSession, folder: str) -> DataFrame:
    return _density(quantiles.long_values(filtered(spark, folder), COLUMNS))


QUERIES["kde"] = kde
ORACLES["kde"] = density_sql(f"{FILTERED_SQL}, v AS ({long_sql(COLUMNS, 'flt')})")


def pooled_kde(spark: SparkSession, folder: str) -> DataFrame:
    return _density(quantiles.long_values(filtered(spark, folder), INPUTS, "X"))


QUERIES["pooled_kde"] = pooled_kde
ORACLES["pooled_kde"] = density_sql(f"{FILTERED_SQL}, v AS ({long_sql(INPUTS, 'flt', 'X')})")


def lineitem_kde(spark: SparkSession, folder: str) -> DataFrame:
    prices = ["l_extendedprice"]
    return _density(quantiles.long_values(table(spark, folder, "lineitem"), prices))


QUERIES["lineitem_kde"] = lineitem_kde
ORACLES["lineitem_kde"] = density_sql(f"v AS ({long_sql(['l_extendedprice'], 'lineitem')})")


def pair_corr(spark: SparkSession, folder: str) -> DataFrame:
    pairs = distributions.pair_correlation(filtered(spark, folder), INPUTS, "y")
    return pairs.select("column", F.round("corr", 6).alias("corr"))


QUERIES["pair_corr"] = pair_corr
ORACLES["pair_corr"] = f"""WITH {FILTERED_SQL} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, y), 6) AS corr FROM flt" for c in INPUTS
)


def pair_points(spark: SparkSession, folder: str) -> DataFrame:
    """The points of the scatter plots of each input against the output."""
    return filtered(spark, folder).unpivot(["doc_id", "y"], INPUTS, "column", "x").select(
        "doc_id", "column", F.round("x", 6).alias("x"), "y"
    )


QUERIES["pair_points"] = pair_points
ORACLES["pair_points"] = f"WITH {FILTERED_SQL} " + " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS \"column\", round({c}, 6) AS x, y FROM flt" for c in INPUTS
)


def pair_bins(spark: SparkSession, folder: str) -> DataFrame:
    return distributions.pair_bins(filtered(spark, folder), "x1", "y", CELLS)


QUERIES["pair_bins"] = pair_bins
ORACLES["pair_bins"] = f"""WITH {FILTERED_SQL},
e AS (SELECT min(x1) AS x0, max(x1) - min(x1) AS dx, min(y) AS y0, max(y) - min(y) AS dy FROM flt)
SELECT least(floor((x1 - x0) / (dx / {CELLS})), {CELLS - 1})::BIGINT AS x_bin,
       least(floor((y - y0) / (dy / {CELLS})), {CELLS - 1})::BIGINT AS y_bin, count(*) AS "count"
FROM flt, e GROUP BY ALL"""


def time_index(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return global_index(events, [F.col("ts"), F.col("event_id")], "t").select("event_id", "t")


QUERIES["time_index"] = time_index
ORACLES["time_index"] = "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS t FROM events"


def frequency_table(spark: SparkSession, folder: str) -> DataFrame:
    return distributions.frequency(table(spark, folder, "events"), "event_type")


QUERIES["frequency_table"] = frequency_table
ORACLES["frequency_table"] = 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type'


def mode_value(spark: SparkSession, folder: str) -> DataFrame:
    return distributions.most_frequent(table(spark, folder, "events"), "event_type")


QUERIES["mode_value"] = mode_value
ORACLES["mode_value"] = """
SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type
ORDER BY count(*) DESC, event_type LIMIT 1
"""


MONTH = "date_trunc('month', l_shipdate)"


def _by_month(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("month", F.expr(f"cast({MONTH} AS date)"))


def grouped_fences(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles and fences of every return flag and month of shipping, exact."""
    found = quantiles.grouped_fences(_by_month(spark, folder), ["l_returnflag", "month"], PRICES)
    return found.select(
        "l_returnflag", "month", "column", "n", *[(F.round(c, 6) + 0.0).alias(c) for c in ("q1", "q3", "lower", "upper")]
    )


QUERIES["grouped_fences"] = grouped_fences
GROUPED_FENCES_SQL = " UNION ALL ".join(
    f"""SELECT l_returnflag, {MONTH}::DATE AS month, '{c}' AS "column", count({c}) AS n,
       quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem GROUP BY ALL"""
    for c in PRICES
)
ORACLES["grouped_fences"] = f"""
SELECT l_returnflag, month, "column", n, round(q1, 6) AS q1, round(q3, 6) AS q3,
       round(q1 - 1.5 * (q3 - q1), 6) + 0.0 AS lower, round(q3 + 1.5 * (q3 - q1), 6) + 0.0 AS upper
FROM ({GROUPED_FENCES_SQL})
"""


def group_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines each month keeps when those outside its own fences go."""
    months = ["l_returnflag", "month"]
    kept = quantiles.without_group_outliers(_by_month(spark, folder), months, PRICES[:2])
    return kept.groupBy(*months).agg(F.count("*").alias("kept"))


QUERIES["group_outliers"] = group_outliers
ORACLES["group_outliers"] = f"""
WITH f AS ({GROUPED_FENCES_SQL}),
l AS (SELECT *, {MONTH}::DATE AS month FROM lineitem)
SELECT l_returnflag, month, count(*) AS kept FROM l
WHERE NOT EXISTS (
  SELECT 1 FROM f WHERE f.l_returnflag = l.l_returnflag AND f.month = l.month AND (
    {" OR ".join(f"""("column" = '{c}' AND ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)))""" for c in PRICES[:2])}))
GROUP BY ALL
"""
