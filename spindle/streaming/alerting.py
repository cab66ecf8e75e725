"""Alert rules on a stream.

Windows over a whole series are not supported on streams, so evaluation is
split. A streaming aggregation emits each (rule, series, bucket) once, when
its bucket is closed: the watermark runs on the points' own end time, so a
bucket of any period stays open until the latest point seen lies
``lateness`` beyond the bucket's end. Rules of one period share a window
aggregation with a watermark of its own.
Each micro-batch writes its closed buckets to its own ``batch_id`` folder of the rollup
table (a replay rewrites the same folder), and ``current_alerts`` runs the
batch operator over that table, which holds one short row per rule, series
and bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindle.functions.labels import series_key
from spindle.operators import alerts as al
from spindle.operators.joins import broadcast_if_small
from spindle.session import stream_checkpoint

ALIGNED_SCHEMA = "rule string, series string, bucket timestamp, value double"


def closed_buckets(points: DataFrame, rules: DataFrame, lateness: str) -> DataFrame:
    """Streaming (rule, series, bucket, value); a bucket is emitted once, when
    the largest end time seen is ``lateness`` past the bucket's end."""
    # Rules are configuration: their distinct periods are a handful of numbers.
    periods = sorted(r["period_s"] for r in rules.select("period_s").distinct().collect())
    if not periods:
        raise ValueError("no alert rules")
    def of_period(period: int) -> DataFrame:
        # A watermark of its own: state behind a shared node is only closed in one branch of the union.
        # Few metric types hold all points: joined by shuffle, a type's points would meet in one task.
        few = broadcast_if_small(rules.where(F.col("period_s") == period), al.MAX_BROADCAST_RULES)
        joined = al.match_rules(points.withWatermark("end_time", lateness), few)
        return (joined.groupBy("rule", "aligner", "period_s", series_key(F.col("labels")).alias("series"),
                               F.window("end_time", f"{period} seconds").alias("w"))
                .agg(al.aligned_value().alias("value"))
                .select("rule", "series", F.col("w.start").alias("bucket"), "value"))

    return reduce(DataFrame.unionByName, map(of_period, periods))


def start_alerting(points: DataFrame, rules: DataFrame, rollup_path: str,
                   checkpoint: str | None = None, lateness: str = "300 seconds",
                   available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream that keeps the rollup table of closed buckets."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{rollup_path}/batch_id={batch_id}")

    ckpt = checkpoint or stream_checkpoint(points.sparkSession, "alerting", rollup_path)
    writer = (closed_buckets(points, rules, lateness).writeStream.outputMode("append")
              .foreachBatch(on_batch).option("checkpointLocation", ckpt))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def current_alerts(spark: SparkSession, rollup_path: str, rules: DataFrame,
                   interval: tuple[int, int] | None = None) -> DataFrame:
    """Alert runs over all closed buckets so far."""
    rollup = spark.read.schema(ALIGNED_SCHEMA).parquet(rollup_path).select("rule", "series", "bucket", "value")
    return al.breach_runs(rollup, rules, interval=interval)
