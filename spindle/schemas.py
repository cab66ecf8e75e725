"""Schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

STR_MAP = T.MapType(T.StringType(), T.StringType())

# Broker message, as a message-queue source (e.g. Kafka) delivers it.
MESSAGE = T.StructType([
    T.StructField("value", T.BinaryType(), True),
    T.StructField("attributes", STR_MAP, True),
    T.StructField("ordering_key", T.StringType(), True),
    T.StructField("message_id", T.StringType(), True),
    T.StructField("publish_time", T.TimestampType(), True),
])

METADATA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("version", T.StringType(), False),
])

# Landed table: the canonical envelope with ``data`` kept as VARIANT.
LANDED = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("processing_timestamp", T.TimestampType(), False),
    T.StructField("data", T.VariantType(), False),
    T.StructField("metadata", METADATA, False),
    T.StructField("attributes", STR_MAP, True),
])

# Flat variant of the landed table: ``data`` as JSON text.
LANDED_FLAT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("data", T.StringType(), False),
    T.StructField("processing_timestamp", T.TimestampType(), False),
])

REJECTS = T.StructType([
    T.StructField("value", T.StringType(), True),
    T.StructField("reject_reason", T.StringType(), False),
    T.StructField("event_id", T.StringType(), True),
    T.StructField("message_id", T.StringType(), True),
    T.StructField("publish_time", T.TimestampType(), True),
    T.StructField("attributes", STR_MAP, True),
])

METRICS = T.StructType([
    T.StructField("metric_type", T.StringType(), False),
    T.StructField("metric_kind", T.StringType(), False),
    T.StructField("value_type", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("labels", STR_MAP, True),
    T.StructField("resource", STR_MAP, True),
    T.StructField("end_time", T.TimestampType(), False),
])

# The same with values in their own type (INT64, DOUBLE, BOOL), as a VARIANT.
TYPED_METRICS = T.StructType([
    T.StructField(f.name, T.VariantType() if f.name == "value" else f.dataType, f.nullable) for f in METRICS.fields])

ALERT_RULES = T.StructType([
    T.StructField("rule", T.StringType(), False),
    T.StructField("metric_type", T.StringType(), False),
    T.StructField("aligner", T.StringType(), False),
    T.StructField("comparison", T.StringType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("duration_s", T.LongType(), False),
    T.StructField("period_s", T.LongType(), False),
    T.StructField("wired", T.BooleanType(), False),
    T.StructField("resource_type", T.StringType(), True),
])

RUNS = T.StructType([
    T.StructField("test_name", T.StringType(), False),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("messages_sent", T.LongType(), True),
    T.StructField("messages_processed", T.LongType(), True),
    T.StructField("avg_latency", T.DoubleType(), True),
    T.StructField("p50_latency", T.DoubleType(), True),
    T.StructField("p95_latency", T.DoubleType(), True),
    T.StructField("p99_latency", T.DoubleType(), True),
    T.StructField("errors", T.LongType(), True),
    T.StructField("throughput", T.DoubleType(), True),
])
