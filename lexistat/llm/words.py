"""Words, row keys and the shared ways of this subpackage to read texts."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs of anything but ASCII white space.
SPACED = r"[^\x20\x09-\x0D]+"
# Runs of lower-case ASCII letters, ASCII digits and everything beyond ASCII.
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(name: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def usual_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(df: DataFrame, rows: int, per_part: int) -> int:
    """Partitions that hold about ``per_part`` of ``rows`` rows each, at least one."""
    return max(1, -(-rows // per_part))


def row_of(df: DataFrame) -> Column:
    """The whole row as one column ``_row``, so that no name in it can clash with ours."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_row")
