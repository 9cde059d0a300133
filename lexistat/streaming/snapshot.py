"""The crawl snapshot as an incremental job: each run parses the pages landed since the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexistat.operators.records import accepted_and_rejected, parse_publications
from lexistat.session import drop
from lexistat.sources.publications import PUBLICATION

PAGES = "page_id bigint, url string, html string"


def land(
    spark: SparkSession, pages: str, accepted: str, rejected: str, progress: str
) -> StreamingQuery:
    """Parse every new page once, append its record to ``accepted`` or ``rejected``, and stop.

    One stream feeds both tables. A batch is parsed into a table of its own, from which each side is
    written to the folder of the batch, replacing what an earlier try has left there. So a batch that is
    ended between its writes and run again leaves no row twice and none out. ``progress`` keeps what has
    been read; with it a restarted run goes on where the last one ended.
    """

    def write(batch: DataFrame, number: int) -> None:
        own = f"{progress}/parsed-{number}"
        parse_publications(batch, "page_id").write.mode("overwrite").parquet(own)
        sides = accepted_and_rejected(batch.sparkSession.read.schema(PUBLICATION).parquet(own))
        for records, target in zip(sides, (accepted, rejected), strict=True):
            write_batch(records, target, number)
        drop(batch.sparkSession, own)

    return (
        spark.readStream.schema(PAGES)
        .parquet(pages)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{progress}/stream")
        .trigger(availableNow=True)
        .start()
    )


def write_batch(rows: DataFrame, target: str, number: int) -> None:
    """The rows of one batch as the folder ``batch=<number>`` of a table, in place of an earlier try."""
    rows.write.mode("overwrite").parquet(f"{target}/batch={number}")


def land_publications(
    spark: SparkSession, pages: str, target: str, progress: str
) -> StreamingQuery:
    """Append the records of new page files to ``target`` and stop.

    In place of rewriting the whole snapshot after every record. ``progress`` keeps what has been
    read; with it a restarted run neither skips nor repeats a file.
    """
    return _land(spark, pages, target, progress, 0)


def land_rejected(spark: SparkSession, pages: str, target: str, progress: str) -> StreamingQuery:
    """Append what ``land_publications`` leaves out, the records without any detail, to ``target``.

    Hand in a ``progress`` of its own.
    """
    return _land(spark, pages, target, progress, 1)


def _land(spark: SparkSession, pages: str, target: str, progress: str, part: int) -> StreamingQuery:
    landed = spark.readStream.schema(PAGES).parquet(pages)
    return (
        accepted_and_rejected(parse_publications(landed, "page_id"))[part]
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
