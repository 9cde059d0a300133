"""Session helpers: local sessions, shared scratch folder, staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The planner gives sizes near the largest long to what it knows nothing about.
UNKNOWN_SIZE = 1 << 60
# A table of fewer full splits than this may be spread over the cores.
FEW_SPLITS = 8
# What a partition of moved texts holds of the stored table: a task makes many times as much of it, one
# counted row for each term of a text.
TEXT_BYTES = 4 << 20
# What a partition of rows that are only sorted holds.
SORT_BYTES = 32 << 20
# More partitions than this cost the driver more than they give the tasks.
MOST_PARTS = 200_000
# Spark writes no more buckets than this.
MOST_HOMES = 100_000
# The column that says in which partition all rows of a key are.
HOME = "_home"


def local_session(app: str = "lexistat", cores: int | str = "*") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. A temporary folder is made
    only on a local master, where driver and executors share one disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


def _file_system(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def dropped_at_exit(spark: SparkSession, path: str) -> str:
    """Have a written folder deleted when the application ends; ``path`` again."""
    files, place = _file_system(spark, path)
    files.deleteOnExit(place)
    return path


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the staged tables that goes with all that is written into it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    files, place = _file_system(spark, path)
    files.mkdirs(place)
    return dropped_at_exit(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of one's own, if it is there."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several passes. The files give the planner a true size, so it
    broadcasts the table only under ``spark.sql.autoBroadcastJoinThreshold``, and they outlive
    any executor. They go when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(dropped_at_exit(spark, path))


def homes(df: DataFrame) -> int:
    """Number of homes for the rows of a table of texts."""
    return min(shuffle_parts(df, TEXT_BYTES), MOST_HOMES)


def home(spark: SparkSession, of: Column, count: int) -> Column:
    """The home of a value, one of ``count`` numbers.

    They are numbers whose hashes fall on different partitions, so that ``repartition(count, HOME)`` gives
    every home a partition of its own; were two to share one, only the sizes of tasks would change.
    """
    number = F.pmod(F.hash("id"), F.lit(count)).alias("number")
    found = spark.range(32 * count).groupBy(number).agg(F.min("id").alias("home")).collect()
    listed = ",".join(str(r["home"]) for r in sorted(found))
    return F.element_at(F.split(F.lit(listed), ",").cast("array<bigint>"), F.pmod(F.hash(of), F.lit(len(found))) + 1)


def stage_homes(df: DataFrame, name: str, count: int) -> DataFrame:
    """``stage`` for rows that lie in ``count`` partitions by ``HOME``: a bucketed table, which is read back so."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = dropped_at_exit(spark, f"{shared_folder(spark)}/staged/{table}")
    df.write.option("path", path).bucketBy(count, HOME).saveAsTable(table)
    return spark.table(table)


def known_size(df: DataFrame) -> int | None:
    """Bytes of ``df`` as the planner estimates them, None if unknown.

    For a join it multiplies the sizes of both sides; what its tables hold together is then the bound.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    leaves = plan.collectLeaves()
    tables = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    size = min(size, tables)
    return None if size >= UNKNOWN_SIZE else size


def full_splits(df: DataFrame) -> int | None:
    """Number of full input splits in the size of ``df``; None if unknown."""
    size = known_size(df)
    return None if size is None else size // df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def few_splits(df: DataFrame) -> bool:
    """True where a table is known to be small and to have fewer full splits than there are cores.

    Small is at most FEW_SPLITS full splits, whatever the cluster; a larger table is never
    shuffled only to use more cores.
    """
    splits = full_splits(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return splits is not None and splits < min(cores, FEW_SPLITS)


def shuffle_parts(df: DataFrame, part_bytes: int = SORT_BYTES) -> int:
    """Partitions for moving whole rows of ``df``: one per core, and for a large table as many as hold
    ``part_bytes`` each, so that a task's share does not grow with the table."""
    spark = df.sparkSession
    size, cores = known_size(df), spark.sparkContext.defaultParallelism
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size is None:
        return usual
    wanted = size // part_bytes
    return max(cores, wanted) if full_splits(df) < cores else min(max(usual, wanted), MOST_PARTS)


def placed(df: DataFrame, key: str) -> DataFrame:
    """Hash a table of texts by ``key``, so that work per key needs no further shuffle."""
    return df.repartition(shuffle_parts(df, TEXT_BYTES), key)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash a small table over the cores by ``key``, so that one file is not one task.

    A large table is returned as it is: it has splits enough, and its text is not shuffled.
    """
    return placed(df, key) if few_splits(df) else df
