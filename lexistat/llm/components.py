"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexistat.session import stage


def roots(nearest: DataFrame) -> DataFrame:
    """``(old, new)`` with every chain of ``nearest(old, new)`` followed to its end.

    Each round doubles how far every row looks, so a chain of n steps takes about log2(n) rounds.
    """
    while True:
        ahead = nearest.toDF("at", "to")
        further = F.coalesce("to", "new")
        moved = stage(
            nearest.join(ahead, nearest["new"] == ahead["at"], "left").select(
                "old", further.alias("new"), (further != F.col("new")).alias("moved")
            ),
            "roots",
        )
        nearest = moved.select("old", "new")
        if moved.filter("moved").isEmpty():
            return nearest


def components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` for every end of ``edges(a, b)``: the smallest id of its component.

    Every round points all ids to the smallest id next to them, follows these pointers to their ends and contracts
    the edges. An id that is left has taken in another one, or does so in the next round, so the ids halve at
    least every second round, whatever the shape. Degrees are only ever reduced to a minimum,
    which combines before the shuffle. Rounds are written, so a lost executor repeats one at most.
    """
    alive = stage(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(),
        "edges",
    )
    ends = alive.select(F.col("a").alias("id")).union(alive.select("b")).distinct()
    labels = stage(ends.withColumn("label", F.col("id")), "labels")
    while not alive.isEmpty():
        both = alive.union(alive.select("b", "a")).toDF("old", "new")
        nearest = roots(
            stage(both.groupBy("old").agg(F.min("new").alias("new")).withColumn("new", F.least("old", "new")), "nearest")
        )
        labels = stage(
            labels.join(nearest, labels["label"] == nearest["old"], "left").select(
                "id", F.coalesce("new", "label").alias("label")
            ),
            "labels",
        )
        ahead = nearest.toDF("a", "c")
        behind = nearest.toDF("b", "d")
        moved = alive.join(ahead, "a").join(behind, "b").select(
            F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")
        )
        alive = stage(moved.filter("a < b").distinct(), "edges")
    return labels
