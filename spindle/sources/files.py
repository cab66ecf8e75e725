"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Rows of a task: what a row is unfolded into (points, parsed messages) is sorted and held per task.
TASK_ROWS = 200_000


def read_parquet(spark: SparkSession, path: str, min_partitions: int | None = None,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """Read parquet; spread an input with fewer splits than the cluster has
    cores, or than ``task_rows`` rows each ask for, over as many tasks.

    A table with enough splits is returned as read, with no shuffle. A small
    file with one row group would otherwise run every CPU-heavy row operator
    (JSON parse) in one task, and a large one that compresses well would give
    each task more rows the larger it is. The rows are counted from the files' footers.
    """
    df = spark.read.parquet(path)
    try:
        target = max(min_partitions or spark.sparkContext.defaultParallelism, -(-df.count() // task_rows))
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): keep the scan as is
        return df
    if current >= target:
        return df
    # Round-robin: its partitioning references no column, so column pruning
    # still reaches the scan (a hash of the row would force reading every
    # column). Spark sorts each input partition first, so a retried task
    # sends every row to the same place.
    return df.repartition(target)
