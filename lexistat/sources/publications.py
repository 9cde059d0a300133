"""The publication schema, its readers and writers, and the signals file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a record.
PUBLICATION = (
    "id bigint, title string, authors array<struct<name:string,link:string>>, author string, "
    "year string, month string, day string, abstract string, detail string, output string, "
    "link string, concepts array<string>"
)
ACCEPTED_FIELDS = ("authors", "title", "year", "month", "day", "abstract")

# The column order of the signals file; the header line is not used.
SIGNAL_FILE_COLUMNS = ("x1", "x3", "x4", "x5", "x2")
SIGNAL_INPUTS = ("x1", "x3", "x4", "x5")


def read_publications(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A JSON array of records, or JSON lines with ``multi_line=False`` (which split)."""
    return spark.read.schema(PUBLICATION).option("multiLine", multi_line).json(path)


def write_publications(records: DataFrame, path: str, format: str = "parquet") -> None:
    """One atomic write of the whole table in place of a snapshot after every record."""
    records.write.mode("overwrite").format(format).save(path)


def write_postings(postings: DataFrame, path: str, format: str = "json") -> None:
    """The inverted index as ``{term, block, postings}`` rows, one folder per first character.

    Lists are ranged by term and block before they are written, so a task writes to few folders, and
    a frequent first character is shared by several tasks.
    """
    first = F.substring("term", 1, 1)
    ranged = postings.withColumn("initial", first).repartitionByRange("initial", "term", "block")
    ranged.write.mode("overwrite").partitionBy("initial").format(
        format
    ).save(path)


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """The signals CSV by position: one header line skipped, ``x2`` is the output ``y``."""
    schema = ", ".join(f"{name} double" for name in SIGNAL_FILE_COLUMNS)
    table = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return complete_cases(table).withColumnRenamed("x2", "y")


def complete_cases(df: DataFrame) -> DataFrame:
    """Rows without a missing value: neither NULL nor NaN in any column."""
    return df.dropna("any")


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
