"""Global positions without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexistat.session import shared_folder, shuffle_parts

_POSITION_BITS = 33


def global_index(
    df: DataFrame, order: list[Column], index: str = "idx", start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the order of ``order``.

    The rows are range-partitioned on the full key and sorted inside their partition, where each
    gets its local position. One count per partition then gives the offsets, so the only window
    runs over as many rows as there are partitions. The numbered partitions are checkpointed:
    positions and counts must come from the same cut. End the key with a unique column; then no
    value, however frequent, is tied to one partition.
    """
    shared_folder(df.sparkSession)
    cuts = partitions or shuffle_parts(df)
    placed = (
        df.repartitionByRange(cuts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_slot", _POSITION_BITS))
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(index, F.col("_offset") + position + F.lit(start))
        .drop("_part", "_slot", "_offset")
    )
