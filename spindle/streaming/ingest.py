"""Streaming ingest: message source -> envelope operators -> landed + rejects sinks.

The transforms are the batch ones (``envelope.outcomes``); only the source
and the sinks differ. Both sinks are written from one pass per micro-batch
in ``foreachBatch``: the batch is persisted once, each sink overwrites its
own ``batch_id=<n>`` folder, so a micro-batch replayed after a failure
rewrites the same files instead of appending twice (exactly-once effect
with an at-least-once source).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindle.operators import envelope
from spindle.schemas import MESSAGE
from spindle.sources import tables
from spindle.session import stream_checkpoint

# Tumbling window and allowed lateness of the deployment config.
WINDOW = "60 seconds"
ALLOWED_LATENESS = "300 seconds"


def read_messages(spark: SparkSession, path: str, streaming: bool = True, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """H1/A1: the same message frame as a stream (default) or a bounded batch.

    Production reads Kafka (``format("kafka")``: value, timestamp, headers,
    key map onto value, publish_time, attributes, ordering_key); files with
    the message schema stand in for it here.
    """
    if not streaming:
        return spark.read.schema(MESSAGE).format(fmt).load(path)
    reader = spark.readStream.schema(MESSAGE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def from_kafka_rows(raw: DataFrame) -> DataFrame:
    """Kafka source rows (key, value, topic, partition, offset, timestamp,
    headers) -> the message schema. The message id is topic-partition-offset,
    stable across replays."""
    attrs = F.map_from_entries(F.transform(
        F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>")),
        lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return raw.select(
        F.col("value"), attrs.alias("attributes"), F.col("key").cast("string").alias("ordering_key"),
        F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"),
                    F.col("offset").cast("string")).alias("message_id"),
        F.col("timestamp").alias("publish_time"),
    )


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka source mapped to the message schema (needs the Kafka connector jar)."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("includeHeaders", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return from_kafka_rows(reader.load())


def batch_points(out: DataFrame, batch_id: int, started: float, finished: float,
                 default_labels: dict[str, str] | None = None) -> DataFrame:
    """Metric points of one micro-batch: counters aggregated per batch (one row
    per metric and label set, value = count), batch size and batch time gauges.
    The end time of every point is the batch's latest publish time."""
    from spindle.operators import metrics as mx

    pts = mx.outcome_points(out, default_labels)
    counters = (pts.where(F.col("metric_kind") == "CUMULATIVE")
                .groupBy("metric_type", "metric_kind", "value_type", "labels", "resource")
                .agg(F.sum("value").alias("value"), F.max("end_time").alias("end_time")))
    base = pts.where(F.col("metric_type") == mx.RECEIVED).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.max("end_time").alias("end_time"))
    labels = F.create_map(*[F.lit(x) for kv in (default_labels or {}).items() for x in kv]) \
        if default_labels else F.create_map().cast("map<string,string>")
    gauges = base.select(F.explode(F.array(
        F.struct(F.lit("batch_size/batch_size").alias("metric_type"), F.lit("INT64").alias("value_type"),
                 F.col("n").alias("value")),
        F.struct(F.lit("latency/batch_processing_time").alias("metric_type"),
                 F.lit("DOUBLE").alias("value_type"), F.lit(float(finished - started)).alias("value")),
    )).alias("g"), "end_time").select(
        F.col("g.metric_type").alias("metric_type"), F.lit("GAUGE").alias("metric_kind"),
        F.col("g.value_type").alias("value_type"), labels.alias("labels"),
        F.create_map(F.lit("type"), F.lit("generic_task")).alias("resource"),
        F.col("g.value").alias("value"), "end_time")
    return counters.unionByName(gauges).withColumn("batch_id", F.lit(batch_id))


def _sink_writer(landed_path: str, rejects_path: str, raw_path: str | None,
                 metrics_path: str | None = None, files_per_date: int | None = None
                 ) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # ``batch`` is already parsed and classified (on the stream, so the
        # counters land in the query progress); the sink-side steps follow.
        started = time.time()
        out = envelope.enforce_required(envelope.conform(batch))
        kept = envelope.sink_columns(out)
        if raw_path:  # the raw copy comes from the same persisted rows: the stream plan runs once
            kept = out.select(*dict.fromkeys([*kept.columns, *MESSAGE.fieldNames()]))
        out = kept.persist()
        try:
            tables.write_landed(envelope.landed(out), f"{landed_path}/batch_id={batch_id}",
                                mode="overwrite", files_per_date=files_per_date)
            envelope.rejects(out).write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
            if raw_path:
                (out.select(*MESSAGE.fieldNames()).withColumn("date", F.to_date("publish_time"))
                 .write.mode("overwrite").partitionBy("date")
                 .parquet(f"{raw_path}/batch_id={batch_id}"))
            if metrics_path:
                pts = batch_points(out, batch_id, started, time.time())
                pts.drop("batch_id").write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch_id}")
        finally:
            out.unpersist()
    return write


def start_ingest(messages: DataFrame, landed_path: str, rejects_path: str,
                 checkpoint: str | None = None, raw_path: str | None = None,
                 metrics_path: str | None = None, files_per_date: int | None = None,
                 available_now: bool = False, processing_time: str | None = None,
                 name: str | None = None) -> StreamingQuery:
    """Start the two-sink ingest stream; optionally a raw lake copy (A15) and
    per-batch metric points (counters, batch size and time: D16, D18).

    Parse and validation run on the stream itself, so every micro-batch's
    progress carries the counters in ``observedMetrics``: ``<name>_parse``
    (received, invalid_utf8, unparsed) and ``<name>`` (received, valid,
    rejected at validation). ``name`` defaults to "ingest". Without an
    explicit checkpoint, the one under the shared folder belongs to this
    landed path and name.
    """
    spark = messages.sparkSession
    ckpt = checkpoint or stream_checkpoint(spark, name or "ingest", landed_path)
    parsed = envelope.parse(messages, observe_as=f"{name or 'ingest'}_parse")
    classified = envelope.classify(parsed, observe_as=name or "ingest")
    writer = classified.writeStream.foreachBatch(
        _sink_writer(landed_path, rejects_path, raw_path, metrics_path, files_per_date)) \
        .option("checkpointLocation", ckpt)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def append_stream(df: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """A4 streaming form: append to a catalog table (created if missing); a row that leaves a REQUIRED field of
    the table NULL fails the query."""
    spark = df.sparkSession
    if not tables.table_exists(spark, table):
        tables.create_table(spark, table, df.schema)
    df = tables.checked(df, table, tables.required_of(spark, table))
    return (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .toTable(table))


def windowed_counts(landed: DataFrame, window: str = WINDOW, lateness: str = ALLOWED_LATENESS,
                    key: str = "event_type") -> DataFrame:
    """H2/H3: tumbling event-time counts with a watermark ``lateness`` behind
    the largest event time seen (append mode emits each window once, after
    the watermark passes its end)."""
    ts = F.col("timestamp").cast("timestamp")
    keyed = landed.withColumn("timestamp", ts).withColumn(
        key, F.try_variant_get(F.col("data"), f'$["{key}"]', "string"))
    return (keyed.withWatermark("timestamp", lateness)
            .groupBy(F.window("timestamp", window).alias("window"), key)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), key, "n"))


def dedupe_within_watermark(landed: DataFrame, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """H4 extension: drop redelivered event ids seen within the watermark.

    Off by default: the reference keeps duplicates (at-least-once).
    """
    return (landed.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
            .withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["event_id"]))


def dedupe_copies(landed: DataFrame, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """H4 extension, skew-safe: one row per (event_id, timestamp), the copy
    with the earliest processing time.

    Written as an aggregation, so copies collapse map-side before the
    shuffle (a group of copies holding a third of all rows costs one row per
    task), unlike ``dropDuplicatesWithinWatermark``, which ships every copy
    to one task. On a stream (append mode) a row is emitted once the
    watermark passes its timestamp; the same function dedupes a batch.
    """
    ts = F.col("timestamp").cast("timestamp")
    cols = [c for c in landed.columns if c not in ("event_id", "timestamp")]
    keyed = landed.withColumn("timestamp", ts)
    if landed.isStreaming:
        keyed = keyed.withWatermark("timestamp", lateness)
    first = F.min_by(F.struct(*cols), F.col("processing_timestamp")).alias("_row")
    return keyed.groupBy("event_id", "timestamp").agg(first).select("event_id", "timestamp", "_row.*")


def export_rollup(points: DataFrame, path: str, checkpoint: str, period: str = "300 seconds",
                  lateness: str = ALLOWED_LATENESS) -> StreamingQuery:
    """Periodic metric export, one row per (type, window), parquet by date."""
    rolled = (points.withWatermark("end_time", lateness)
              .groupBy("metric_type", F.window("end_time", period).alias("w"))
              .agg(F.sum("value").alias("sum"), F.count("value").alias("n"))
              .select("metric_type", F.col("w.start").alias("bucket"), "sum", "n",
                      F.to_date(F.col("w.start")).alias("date")))
    return (rolled.writeStream.outputMode("append").format("parquet").partitionBy("date")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(processingTime=period).start())
