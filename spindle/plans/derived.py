"""Inputs derived from the driver's ``events`` table by Spark, deterministically.

* messages: one broker message per event, with seeded faults by ``event_id % 20``
  (and ``% 40`` to split the first fault into bad JSON / bad UTF-8).
* outcomes / landed: the envelope operators applied to those messages.
* metrics: latency gauge points per event, one series per event type.
* runs: one run per hour of the event span.

Everything scales with ``events``; nothing is sampled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators import envelope
from spindle.sources import store as store_io
from spindle.sources.files import read_parquet
from spindle.sources.publish import publish_bytes
from spindle.session import configure, materialize

# Fault kinds by event_id % 20 (8..19 stay valid; 8..12 vary
# the valid shape).
FAULTS = {
    0: "invalid JSON (event_id % 40 = 0) or invalid UTF-8 (event_id % 40 = 20)",
    1: "no data key",
    2: "timestamp not ISO-8601, or (event_id % 40 = 22) not a string",
    3: "metadata is an array",
    4: "metadata without version",
    5: "top level is an array",
    6: "event_id is JSON null",
    7: "trailing text after the object, or (event_id % 40 = 27) a further member",
    8: "timestamp with Z suffix",
    9: "timestamp at +05:00",
    10: "timestamp at -03:30",
    11: "extra top-level key",
    12: "event_id key repeated, last wins",
}

LATENCY_METRIC = "latency/processing_latency"
FIRST_VALID = 8  # event_id % 20 of the first kind of message that is processed
DEFAULT_LABELS = {"environment": "test", "service": "spindle"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return load(spark, sf_dir, "events")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker messages (value, attributes, ordering_key, message_id, publish_time)."""
    ev = events(spark, sf_dir)
    eid = F.col("event_id")
    k = eid % 20
    tag = F.concat(F.lit("evt-"), eid.cast("string"))
    ts = F.col("ts").cast("timestamp_ntz")
    ts_text = (
        F.when(k == 8, F.concat(_iso(ts), F.lit("Z")))
        .when(k == 9, F.concat(_iso(ts + F.expr("INTERVAL 5 HOURS")), F.lit("+05:00")))
        .when(k == 10, F.concat(_iso(ts - F.expr("INTERVAL '3:30' HOUR TO MINUTE")), F.lit("-03:30")))
        .when(k == 2, F.lit("yesterday"))
        .otherwise(_iso(ts))
    )
    # The JSON text is assembled from parts so each fault is a small edit of
    # one part (keeps the generated code small).
    q = F.lit('"')
    eid_json = F.when(k == 6, F.lit("null")).otherwise(F.concat(q, tag, q))
    meta_json = (
        F.when(k == 3, F.to_json(F.array(F.col("event_type"), F.lit("1.0"))))
        .when(k == 4, F.to_json(F.struct(F.col("event_type").alias("source"))))
        .otherwise(F.to_json(F.struct(F.col("event_type").alias("source"), F.lit("1.0").alias("version"))))
    )
    members = F.concat(
        F.when(k == 12, F.lit('"event_id":"dup",')).otherwise(F.lit("")),
        F.lit('"event_id":'), eid_json,
        F.lit(',"timestamp":'), F.when(eid % 40 == 22, F.lit("5")).otherwise(F.concat(q, ts_text, q)),
        F.when(k == 1, F.lit("")).otherwise(F.concat(F.lit(',"data":'), F.to_json(F.col("_data")))),
        F.lit(',"metadata":'), meta_json,
        F.when(k == 11, F.lit(',"extra":1')).otherwise(F.lit("")),
    )
    text = (
        F.when(k == 0, F.concat(F.lit("{"), F.col("_members")))  # object never closed
        .when(k == 5, F.concat(F.lit("["), F.col("_base"), F.lit("]")))
        .when(eid % 40 == 27, F.concat(F.col("_base"), F.lit(',"q":1')))
        .when(k == 7, F.concat(F.col("_base"), F.lit(" x")))
        .otherwise(F.col("_base"))
    )
    value = F.when(
        eid % 40 == 20, F.concat(F.unhex(F.lit("FFFE")), F.encode(F.col("_base"), "UTF-8"))
    ).otherwise(F.encode(F.col("_text"), "UTF-8"))
    publish_time = F.timestamp_micros(
        F.unix_micros(ts.cast("timestamp")) + (eid % 30) * F.lit(1_000_000)
    )
    staged = (
        ev.withColumn("_data", F.struct(
            F.col("user_id").alias("user_id"),
            F.col("event_type").alias("event_type"),
            F.col("value").alias("value"),
            F.try_parse_json(F.col("props")).alias("props"),
        ))
        .withColumn("_members", members)
        .withColumn("_base", F.concat(F.lit("{"), F.col("_members"), F.lit("}")))
        .withColumn("_text", text)
    )
    return publish_bytes(
        staged,
        value=value,
        message_id=F.concat(F.lit("msg-"), eid.cast("string")),
        publish_time=publish_time,
        ordering_key=F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        attributes=F.create_map(
            F.lit("batch_id"), F.concat(F.lit("batch-"), F.floor(eid / 100).cast("string")),
            F.lit("source"), F.lit("events"),
        ),
    )


def interval(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Epoch seconds of the first and last message received (no payload is read)."""
    at = F.unix_seconds("publish_time")
    return tuple(messages(spark, sf_dir).agg(F.min(at), F.max(at)).first())


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.outcomes(messages(spark, sf_dir))


_STORES: dict[tuple, str] = {}


def store(spark: SparkSession, sf_dir: str) -> str:
    """Path of the store of landed rows and counts, written by the first query of a session that asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STORES:
        path = store_io.at_path(spark, uuid.uuid4().hex)
        # Parsed once, kept in columns: sorting and counting by id and time then read little of the payload.
        keep = [*envelope.LANDED_COLUMNS, "reject_reason"]
        outcomes(spark, sf_dir).select(*keep).write.parquet(f"{path}/outcomes")
        out = store_io.read(spark, path, "outcomes")
        store_io.write_rows(envelope.landed(out), path)
        store_io.write_counts(out.select(
            "event_id", "timestamp",
            F.when(F.col("reject_reason").isNull(), F.col("processing_timestamp")).alias("processing_timestamp"),
            F.col("attributes")["batch_id"].alias("batch_id")), path)
        _STORES[key] = path
    return _STORES[key]


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.landed(outcomes(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency gauge points of all events: one series per event type (label ``event_type``)."""
    return _latency_points(events(spark, sf_dir))


def processed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency points of the messages that are processed."""
    return _latency_points(events(spark, sf_dir).where(F.col("event_id") % 20 >= FIRST_VALID))


def _latency_points(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.lit(LATENCY_METRIC).alias("metric_type"),
        F.lit("GAUGE").alias("metric_kind"),
        F.lit("DOUBLE").alias("value_type"),
        F.col("value").cast("double").alias("value"),
        F.map_concat(
            F.create_map(*[x for kv in DEFAULT_LABELS.items() for x in map(F.lit, kv)]),
            F.create_map(F.lit("event_type"), F.col("event_type")),
        ).alias("labels"),
        F.create_map(F.lit("type"), F.lit("generic_task"), F.lit("job"), F.lit("ingest")).alias("resource"),
        F.col("ts").cast("timestamp").alias("end_time"),
    )


def hourly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per hour from the first to the last event hour (empty hours included)."""
    ev = events(spark, sf_dir)
    span = ev.agg(
        F.date_trunc("hour", F.min(F.col("ts").cast("timestamp"))).alias("lo"),
        F.date_trunc("hour", F.max(F.col("ts").cast("timestamp"))).alias("hi"),
    )
    hours = span.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("start_time")
    )
    runs = hours.select(
        F.concat(F.lit("run-"), F.date_format("start_time", "yyyyMMddHH")).alias("test_name"),
        "start_time",
        (F.col("start_time") + F.expr("INTERVAL 1 HOUR")).alias("end_time"),
    )
    # One row per hour of the span; several branches of a run query read it,
    # so it is computed once and read back from the checkpoint folder.
    return materialize(runs)
