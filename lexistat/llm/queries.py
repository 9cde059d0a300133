"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.llm import (
    adscan,
    alignment,
    binary,
    chosenpath,
    importance,
    licenses,
    linededup,
    mixing,
    mtree,
    packing,
    quality,
    tokencounts,
    toxicity,
)
from lexistat.session import own_folder
from lexistat.sources.tables import table


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return chosenpath.linked(table(spark, folder, "documents"), size=3, percent=85)


def op3_inner_product_topk(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_cosine_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return adscan.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"))
    return packed.withColumns({c: packed[c].cast("long") for c in ("length", "offset")})


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{own_folder(spark, 'tokens')}/files"
    binary.write(table(spark, folder, "documents"), files)
    return binary.read(spark, files)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = linededup.cleaned(table(spark, folder, "documents"))
    return done.select("row.doc_id", "n_lines", "n_removed", "text")


def op11_cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.cross_tokenizer(table(spark, folder, "documents"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every call begins with an empty cache, so that it counts the whole table."""
    return tokencounts.count_tokens(table(spark, folder, "documents"), own_folder(spark, "token-counts"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_inner_product_topk": op3_inner_product_topk,
    "op4_cosine_neighbours": op4_cosine_neighbours,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_token_files": op6_token_files,
    "op7_quality": op7_quality,
    "op8_source_mix": op8_source_mix,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_cross_tokenizer": op11_cross_tokenizer,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_token_counts": op13_token_counts,
}
ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.SQL,
    "op2_near_duplicates": chosenpath.SQL,
    "op3_inner_product_topk": mtree.SQL,
    "op8_source_mix": mixing.SQL,
    "op10_line_dedup": linededup.SQL,
}
