"""Periodic export of metric points at several periods from one streaming query.

The shortest period is aggregated from the points; every longer one from the shorter one's closed
windows (a window over ``window_time``), so the longer periods keep a row per series and short window at most, not points.
A micro-batch writes the windows that it closes to one folder per period, named by batch, so a replay rewrites them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindle.operators import rollup as ru
from spindle.session import stream_checkpoint

# Export intervals of the monitoring configuration (warehouse table, storage bucket), seconds.
EXPORT_PERIODS = (300, 3600)


def export_rows(points: DataFrame, periods: tuple[int, ...] = EXPORT_PERIODS, lateness: str = "300 seconds") -> DataFrame:
    """Stream of (period_s, metric_type, series, bucket, sum, n, min, max, sketch, date), each window once."""
    if not periods or any(b % a for a, b in zip(periods, periods[1:])) or sorted(set(periods)) != list(periods):
        raise ValueError("every period must be a multiple of the one before it")

    def of(i: int) -> DataFrame:
        # A chain of its own for each period: state behind a shared node is only closed in one branch of the union.
        rows = ru.rollup(points.withWatermark("end_time", lateness), periods[0])
        for period in periods[1:i + 1]:
            rows = ru.coarser(rows, period)
        return ru.stored(rows).withColumn("period_s", F.lit(periods[i]))

    return reduce(DataFrame.unionByName, map(of, range(len(periods))))


def start_export(points: DataFrame, paths: dict[int, str], checkpoint: str | None = None,
                 lateness: str = "300 seconds", available_now: bool = False,
                 processing_time: str | None = None) -> StreamingQuery:
    """``paths``: period in seconds -> folder (its own sink: a warehouse table's files, a storage bucket)."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for period, path in paths.items():
                (batch.where(F.col("period_s") == period).drop("period_s")
                 .write.mode("overwrite").partitionBy("date").parquet(f"{path}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    periods = tuple(sorted(paths))
    writer = (export_rows(points, periods, lateness).writeStream.outputMode("append").foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint
                      or stream_checkpoint(points.sparkSession, "export", "|".join(paths[p] for p in periods))))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time or f"{periods[0]} seconds")
    return writer.start()
