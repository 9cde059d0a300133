"""URLs that no earlier landing has brought, with a memory that outlives the runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexistat.operators.urls import first_seen

BUCKETS = 64
ORDER = ("page_id", "place")
LANDED = "page_id bigint, place int, url string"
SEEN = f"url string, {LANDED.removesuffix(', url string')}, bucket int, batch bigint"


def bucket(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(BUCKETS)).cast("int")


def seen(spark: SparkSession, folder: str) -> DataFrame:
    """``(url, page_id, place, bucket, batch)``: every URL once, with its oldest place and its landing."""
    spark.createDataFrame([], SEEN).write.mode("append").partitionBy("batch", "bucket").parquet(folder)
    return spark.read.schema(SEEN).parquet(folder)


def new_urls(found: DataFrame, known: DataFrame) -> DataFrame:
    """``(url, page_id, place, bucket)``: URLs of ``found`` that ``known`` lacks, each at its oldest place.

    Both sides meet by bucket and URL, so that of the known ones only the buckets are read that a
    small landing has.
    """
    first = first_seen(found.select(*ORDER, "url").where("url is not null"), list(ORDER))
    placed = first.withColumn("bucket", bucket(F.col("url")))
    return placed.join(known.select("bucket", "url"), ["bucket", "url"], "left_anti")


def land_urls(spark: SparkSession, landed: str, folder: str, progress: str) -> StreamingQuery:
    """Remember the URLs of new files of ``landed(page_id, place, url)`` in ``folder``, and stop.

    A URL that an earlier landing has brought keeps its place there and does not come again. What a
    landing has found is ``seen(...)`` of its batch. A batch that is run again replaces its own folder
    and is compared with the landings before it only.
    """

    def write(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        before = seen(own, folder).where(F.col("batch") < number)
        rows = new_urls(batch, before)
        # One file per bucket, whatever the landing.
        parted = rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
        parted.parquet(f"{folder}/batch={number}")

    return (
        spark.readStream.schema(LANDED)
        .parquet(landed)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
