"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (through ``derived``) and returns result
columns with plain types (timestamps as TIMESTAMP_NTZ in UTC, doubles
rounded where a sum order could show) so they compare across engines.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.functions.jsonfn import get
from spindle.functions.labels import series_key
from spindle.functions.timefmt import seconds_between, to_naive
from spindle.operators import alerts as al
from spindle.operators import audit, envelope, hooks
from spindle.operators import metrics as mx
from spindle.operators import runs as rn
from spindle.plans import derived
from spindle.sources import batches, results, store, tables
from spindle.sources.publish import publish, publish_bytes
from spindle.schemas import LANDED, LANDED_FLAT
from spindle.streaming import held, ordered

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Fixed parameters of the SQL corpus queries.
NOW = "2024-01-16 00:00:00"
WINDOW_START = "2024-01-10 00:00:00"
WINDOW_END = "2024-01-20 00:00:00"
BATCH_ID = "batch-42"
LOOKUP_ID = "evt-28"
PREFIX = "evt-9%"


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _parsed(spark, sf):
    return envelope.parse(derived.messages(spark, sf))


def _classified(spark, sf):
    return envelope.classify(_parsed(spark, sf))


def _leaves() -> list:
    return [
        get(F.col("data"), "user_id", "bigint").alias("user_id"),
        get(F.col("data"), "value", "double").alias("value"),
    ]


# ---------------------------------------------------------------- publish / parse


@register
def publish_envelope(spark, sf):
    """A2: rows -> JSON message bytes with attributes and ordering key, read back."""
    ev = derived.events(spark, sf)
    eid = F.col("event_id")
    msgs = publish(
        ev,
        payload=F.struct(
            F.concat(F.lit("evt-"), eid.cast("string")).alias("event_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.struct("user_id", "event_type", "value", F.try_parse_json("props").alias("props")).alias("data"),
            F.struct(F.col("event_type").alias("source"), F.lit("1.0").alias("version")).alias("metadata"),
        ),
        message_id=F.concat(F.lit("msg-"), eid.cast("string")),
        publish_time=F.col("ts"),
        ordering_key=F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        attributes=F.create_map(F.lit("batch_id"),
                                F.concat(F.lit("batch-"), F.floor(eid / 100).cast("string"))),
    )
    doc = F.parse_json(F.col("value").cast("string"))
    return msgs.select(
        "message_id",
        get(doc, "event_id", "string").alias("event_id"),
        get(doc, ("data", "user_id"), "bigint").alias("user_id"),
        get(doc, ("data", "event_type"), "string").alias("event_type"),
        get(doc, ("data", "value"), "double").alias("value"),
        get(doc, ("data", "props", "k"), "bigint").alias("props_k"),
        "ordering_key",
        F.col("attributes")["batch_id"].alias("batch_id"),
    )


# Limits of the publish batches, for messages that come some minutes apart.
BATCH_LIMITS = batches.Limits(max_messages=25, max_bytes=240, max_latency_us=4 * 3_600_000_000)


@register
def publish_batches(spark, sf):
    """A3: messages cut into publish batches per ordering key by count, bytes and latency."""
    ev = derived.events(spark, sf)
    eid = F.col("event_id")
    msgs = publish_bytes(ev, F.encode("props", "UTF-8"), message_id=F.lpad(eid.cast("string"), 12, "0"),
                         publish_time=F.col("ts").cast("timestamp"), ordering_key=F.col("event_type"))
    sizes = batches.batch_sizes(batches.with_batches(msgs, BATCH_LIMITS))
    return sizes.select("ordering_key", "batch", "messages", "bytes", to_naive(F.col("first_time")).alias("first_time"),
                        to_naive(F.col("last_time")).alias("last_time"))


def _parsed_ok():
    return envelope.parsed_object()


@register
def parse_json(spark, sf):
    """Strict UTF-8 + JSON parse; only JSON objects count as parsed."""
    return _parsed(spark, sf).select("message_id", F.coalesce(_parsed_ok(), F.lit(False)).alias("parsed_ok"))


@register
def enrich_processing_ts(spark, sf):
    """processing_timestamp is the message's element (publish) time."""
    return _parsed(spark, sf).where(_parsed_ok()).select(
        "message_id", to_naive(F.col("processing_timestamp")).alias("processing_timestamp"))


@register
def validate_required(spark, sf):
    """The four top-level keys must be present (JSON null counts as present)."""
    has = F.lit(True)
    for k in envelope.REQUIRED_FIELDS:
        has = has & envelope.has(k)
    return _parsed(spark, sf).where(_parsed_ok()).select("message_id", has.alias("has_required"))


@register
def validate_timestamp(spark, sf):
    """Timestamp must be a strict ISO-8601 string."""
    c = _classified(spark, sf)
    reached = ~F.col("reject_reason").isin("invalid_utf8", "json_syntax", "not_object", "missing_fields") | \
        F.col("reject_reason").isNull()
    return c.where(reached).select(
        "message_id", F.col("_ts").isNotNull().alias("ts_ok"), to_naive(F.col("_ts")).alias("timestamp"))


@register
def ingest_valid(spark, sf):
    """B10/B11 flagship: parse -> validate -> typed envelope, validator semantics."""
    valid = envelope.conform(envelope.apply_transforms(derived.messages(spark, sf)))
    return valid.select(
        "event_id",
        to_naive(F.col("timestamp")).alias("timestamp"),
        to_naive(F.col("processing_timestamp")).alias("processing_timestamp"),
        F.col("metadata.source").alias("source"),
        F.col("metadata.version").alias("version"),
        *_leaves(),
    )


@register
def reject_reasons(spark, sf):
    """Reason taxonomy with precedence, REQUIRED check last."""
    o = derived.outcomes(spark, sf)
    return (o.where(F.col("reject_reason").isNotNull())
            .groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")))


@register
def conform_schema(spark, sf):
    """Typed leaves of the landed table."""
    ld = derived.landed(spark, sf)
    d = F.col("data")
    return ld.select(
        "event_id",
        to_naive(F.col("timestamp")).alias("timestamp"),
        to_naive(F.col("processing_timestamp")).alias("processing_timestamp"),
        get(d, "user_id", "bigint").alias("user_id"),
        get(d, "event_type", "string").alias("event_type"),
        get(d, "value", "double").alias("value"),
        get(d, ("props", "k"), "bigint").alias("props_k"),
        F.col("metadata.source").alias("source"),
        F.col("metadata.version").alias("version"),
    )


@register
def conform_flat(spark, sf):
    """Flat table, data as JSON text."""
    flat = envelope.conform_flat(derived.landed(spark, sf))
    return flat.select(
        "event_id", to_naive(F.col("timestamp")).alias("timestamp"), "data",
        to_naive(F.col("processing_timestamp")).alias("processing_timestamp"))


@register
def table_rows(spark, sf):
    """A table made from an explicit schema, flat rows appended in two parts, read by SQL."""
    name = f"flat_{uuid.uuid4().hex}"
    tables.create_table(spark, name, LANDED_FLAT, path=store.at_path(spark, name))
    flat = envelope.conform_flat(derived.landed(spark, sf))
    even = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    for part in (even, ~even):
        tables.append(flat.where(part), name)
    return tables.query(spark, f"SELECT event_id, CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp FROM {name}")


@register
def insert_errors(spark, sf):
    """Insert rows into a REQUIRED schema, return the per-row errors."""
    valid = envelope.conform(envelope.apply_transforms(derived.messages(spark, sf)))
    rows = valid.select(*[c for c in LANDED.fieldNames()])
    _, errors = tables.insert_rows(rows, LANDED)
    return errors.select(to_naive(F.col("timestamp")).alias("timestamp"), "error_field", "error")


@register
def nested_lookup(spark, sf):
    """Nested field read from data and equality check."""
    ld = derived.landed(spark, sf)
    return ld.select("event_id", (get(F.col("data"), "event_type", "string") == F.lit("purchase"))
                     .alias("matches"))


# ---------------------------------------------------------------- hook and storage


def shares(event_type: str | None, user_id: int, value: float):
    """An example hook: a value split into as many shares as the user's number says, none, one or three; one kind fails."""
    if user_id % 4 == 3:
        raise ValueError(f"no shares for user {user_id}")
    n = (0, 1, 3)[user_id % 4]
    for i in range(n):
        yield i, round(value / n, 6), event_type


SHARES = T.StructType([T.StructField("share", T.IntegerType()), T.StructField("amount", T.DoubleType()),
                       T.StructField("kind", T.StringType())])


def _hook_inputs() -> list:
    return ["event_id", get(F.col("data"), "event_type", "string").alias("event_type"), *_leaves()]


def _expanded(rows):
    return hooks.expand(rows, shares, ["event_type", "user_id", "value"], SHARES)


def _stored(spark, df, name):
    """``df`` written once to the shared folder, for the branches that read it."""
    path = store.at_path(spark, f"{uuid.uuid4().hex}/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@register
def hook_rows(spark, sf):
    """K: a user's generator between validation and the sink, 0, 1 or 3 rows for a message, or an error row."""
    rows = _expanded(derived.landed(spark, sf).select(*_hook_inputs()))
    return rows.select("event_id", "share", _rd(F.col("amount")).alias("amount"), "kind", "hook_error")


@register
def errors_all_stages(spark, sf):
    """Rejects of parsing and validation, of the sink's REQUIRED columns, of the hook, and rows that
    the stored table's types do not take, by stage."""
    # Messages are parsed once and the hook runs once; rejects, errors and rows are read from what they gave.
    out = _stored(spark, derived.outcomes(spark, sf).select("reject_reason", *_hook_inputs()), "outcomes")
    landed = out.where("reject_reason IS NULL").drop("reject_reason")
    good, failed = hooks.split(_stored(spark, _expanded(landed), "expanded"))
    # A table whose amounts have two digits before the point; one per session.
    name = "shares_" + re.sub(r"\W", "_", spark.sparkContext.applicationId)
    tables.create_table(spark, name, SHARES_TABLE, path=store.at_path(spark, f"{uuid.uuid4().hex}/{name}"))
    _, dead = tables.fit_to_table(good.select("event_id", "share", "amount", "kind"), name)
    rejects = (out.where("reject_reason IS NOT NULL").select("reject_reason")
               .unionByName(failed.select("reject_reason"))
               .unionByName(dead.select(F.col("error").alias("reject_reason"))))
    return mx.errors_by_stage(rejects)


SHARES_TABLE = T.StructType([T.StructField("event_id", T.StringType(), False), T.StructField("share", T.IntegerType()),
                             T.StructField("amount", T.DecimalType(4, 2)), T.StructField("kind", T.StringType())])


# ---------------------------------------------------------------- SQL corpus


_COUNTS_SQL = """
SELECT count(*) AS sent, count_if(processed) AS processed
FROM {t}
WHERE timestamp BETWEEN CAST(:start_time AS TIMESTAMP) AND CAST(:end_time AS TIMESTAMP)
  AND date BETWEEN CAST(CAST(:start_time AS TIMESTAMP) AS DATE) AND CAST(CAST(:end_time AS TIMESTAMP) AS DATE)
  AND batch_id = :batch_id
"""


@register
def message_counts(spark, sf):
    """Q5: sent vs processed in a time range: two sums of the stored minute counts and the two edge minutes."""
    return store.count_between(spark, derived.store(spark, sf), WINDOW_START, WINDOW_END)


@register
def message_counts_batch(spark, sf):
    """Q5 with the optional batch conjunct, named parameters, over the stored moments of the dates in range."""
    return spark.sql(_COUNTS_SQL, args={"start_time": WINDOW_START, "end_time": WINDOW_END, "batch_id": BATCH_ID},
                     t=store.read(spark, derived.store(spark, sf), store.MOMENTS))


@register
def message_counts_landed(spark, sf):
    """Q5 over the one landed table: rows in range, and those of them with a processing timestamp."""
    return rn.message_counts(store.read(spark, derived.store(spark, sf), store.ROWS), WINDOW_START, WINDOW_END)


@register
def recent_count(spark, sf):
    """Q1: rows in the last minute before a fixed 'now' (lower bound only), from the stored counts."""
    since = F.lit(NOW).cast("timestamp") - F.expr("INTERVAL 1 MINUTE")
    counted = store.count_between(spark, derived.store(spark, sf), since)
    return counted.select(F.col("processed").alias("n"))


@register
def point_lookup(spark, sf):
    """Q2: select by event_id from the sorted store."""
    ld = store.lookup(spark, derived.store(spark, sf), LOOKUP_ID)
    return ld.select(
        "event_id", to_naive(F.col("timestamp")).alias("timestamp"),
        to_naive(F.col("processing_timestamp")).alias("processing_timestamp"),
        F.col("metadata.source").alias("source"), F.col("metadata.version").alias("version"),
        *_leaves())


@register
def prefix_count(spark, sf):
    """Q3: LIKE prefix and last minute, over the sorted store (the pattern is a pushed prefix filter)."""
    return spark.sql(
        "SELECT count(*) AS n FROM {t} WHERE event_id LIKE :prefix "
        "AND timestamp >= CAST(:now AS TIMESTAMP) - INTERVAL 1 MINUTE",
        args={"now": NOW, "prefix": PREFIX}, t=store.read(spark, derived.store(spark, sf), store.ROWS))


@register
def sample_rows(spark, sf):
    """Q4: LIMIT 10 (ordered by event_id so the rows are reproducible)."""
    ld = store.read(spark, derived.store(spark, sf), store.ROWS)
    return ld.orderBy("event_id").limit(10).select(
        "event_id", to_naive(F.col("timestamp")).alias("timestamp"))


@register
def end_to_end_latency(spark, sf):
    """Processing time minus event time, seconds."""
    ld = derived.landed(spark, sf)
    return ld.select("event_id", F.round(seconds_between(F.col("timestamp"), F.col("processing_timestamp")), 9)
                     .alias("latency_s"))


@register
def tumbling_counts(spark, sf):
    """H2: 60 s tumbling event-time windows per event type."""
    ld = derived.landed(spark, sf)
    w = F.window(F.col("timestamp"), "60 seconds")
    return (ld.groupBy(w.alias("w"), get(F.col("data"), "event_type", "string").alias("event_type"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(to_naive(F.col("w.start")).alias("window_start"), "event_type", "n"))


@register
def duplicate_ids(spark, sf):
    """H4 (extension): at-least-once redelivery keeps duplicates; find them."""
    m = derived.messages(spark, sf)
    ld = envelope.landed(envelope.outcomes(m.unionByName(m)))
    return (ld.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


@register
def reconcile(spark, sf):
    """Extension: published event ids that never landed (anti join)."""
    ev = derived.events(spark, sf)
    published = ev.select(F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"))
    # One row per landed id before the shuffle: redelivered or hot ids cost
    # one row each on the build side.
    ld = derived.landed(spark, sf).select("event_id").distinct()
    return published.join(ld, "event_id", "left_anti")


# ---------------------------------------------------------------- metrics


HOUR = 3600
PS = (0.5, 0.95, 0.99)
SCAN_START = "2024-01-10 00:00:00"
SCAN_END = "2024-01-12 00:00:00"
# Label values whose stats are requested beside those of the data; the last one has no points (mean 0.0).
REQUESTED_TYPES = ("click", "error", "purchase", "signup", "view", "refund")


def _points(spark, sf, error_rate=False):
    return mx.outcome_points(derived.outcomes(spark, sf), derived.DEFAULT_LABELS, error_rate=error_rate)


def _latency(spark, sf):
    return derived.metrics(spark, sf)


def _processed_latency(spark, sf):
    return derived.processed_metrics(spark, sf)


def _rd(c):
    # 9 decimals: far from any cross-engine summation error, and a mean of
    # two-decimal values cannot end in an exact tie at the 10th decimal for
    # group sizes here (a tie at 6 decimals does occur at sf0.1).
    return F.round(c, 9)


@register
def metrics_points(spark, sf):
    """Counter and latency points from per-message outcomes."""
    p = _points(spark, sf)
    return p.select("metric_type", "metric_kind", "value_type", _rd(F.col("value")).alias("value"),
                    series_key(F.col("labels")).alias("series"), to_naive(F.col("end_time")).alias("end_time"))


@register
def typed_points(spark, sf):
    """Points that keep their type, written to the point store by date, scanned back and read by type."""
    eid = F.col("event_id")
    points = mx.typed_points(
        derived.events(spark, sf), [
            ("counter/offset", "CUMULATIVE", "INT64", eid + F.lit((1 << 53) + 1)),
            ("gauge/value", "GAUGE", "DOUBLE", F.col("value")),
            ("gauge/value_whole", "GAUGE", "INT64", F.col("value")),
            ("gauge/is_error", "GAUGE", "BOOL", F.col("event_type") == "error")],
        F.col("ts").cast("timestamp"), derived.DEFAULT_LABELS)
    path = store.at_path(spark, f"{uuid.uuid4().hex}/points")
    tables.write_points(points, path)
    back = spark.read.parquet(path)
    return back.select("metric_type", "metric_kind", "value_type", *[
        mx.value_as(t).alias(f"{t.lower()}_value") for t in mx.VALUE_TYPES], to_naive(F.col("end_time")).alias("end_time"))


@register
def metric_scan(spark, sf):
    """Exact type and resource type within an inclusive interval, all series."""
    s = mx.scan(_latency(spark, sf), derived.LATENCY_METRIC, SCAN_START, SCAN_END, "generic_task")
    return s.select(series_key(F.col("labels")).alias("series"), "value",
                    to_naive(F.col("end_time")).alias("end_time"))


@register
def metric_stats(spark, sf):
    """D3: count and mean per series of the data or requested, in an interval; 0.0 when empty."""
    s = mx.scan(_latency(spark, sf), derived.LATENCY_METRIC, SCAN_START, SCAN_END)
    st = mx.stats(s.withColumn("event_type", F.col("labels")["event_type"]), ["event_type"])
    req = (derived.events(spark, sf).select("event_type")
           .unionByName(spark.createDataFrame([(t,) for t in REQUESTED_TYPES], "event_type string")).distinct())
    st = st.withColumnRenamed("event_type", "of")
    return (req.join(st, F.col("event_type").eqNullSafe(F.col("of")), "left")
            .select("event_type", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                    _rd(F.coalesce("mean", F.lit(0.0))).alias("mean")))


@register
def metric_percentiles(spark, sf):
    """Exact floor-index p50/p95/p99 per series."""
    x = mx.with_series(_latency(spark, sf))
    return mx.percentiles(x, ["series"], PS)


@register
def aligned_mean(spark, sf):
    """Per-series mean per one-hour alignment period."""
    x = mx.with_series(_latency(spark, sf))
    a = mx.aligned(x, HOUR, "mean", ["series"])
    return a.select("series", to_naive(F.col("bucket")).alias("bucket"), _rd(F.col("value")).alias("mean"), "n")


@register
def outcome_counts(spark, sf):
    """Received / processed / failed per hour."""
    c = mx.outcome_counts(derived.outcomes(spark, sf), HOUR)
    return c.select(to_naive(F.col("bucket")).alias("bucket"), "received", "processed", "failed")


@register
def errors_by_stage(spark, sf):
    """Rejects counted by error stage."""
    return mx.errors_by_stage(envelope.rejects(derived.outcomes(spark, sf)))


@register
def batch_stats(spark, sf):
    """Batch size and time span per batch id."""
    b = mx.batch_stats(derived.outcomes(spark, sf))
    return b.select("batch_id", "batch_size", _rd(F.col("span_s")).alias("span_s"))


@register
def dashboard_rollup(spark, sf):
    """Hourly panel values, one column per panel (explicit pivot values)."""
    pts = _points(spark, sf).unionByName(_processed_latency(spark, sf))
    d = mx.dashboard(pts, HOUR, mx.PANELS)
    return d.select(to_naive(F.col("bucket")).alias("bucket"), *[_rd(F.col(c)).alias(c) for c in mx.PANELS])


@register
def reject_log_rows(spark, sf):
    """One structured log row per rejected message."""
    return audit.log_rows(envelope.rejects(derived.outcomes(spark, sf)))


# ---------------------------------------------------------------- alerts


def _alert_out(df):
    return df.select("rule", "series", to_naive(F.col("start_time")).alias("start_time"),
                     to_naive(F.col("end_time")).alias("end_time"), "buckets")


@register
def alerts_latency(spark, sf):
    """H5/H6: mean latency above 30 for 5 h, hourly alignment, per series."""
    rules = al.rules_frame(spark, [al.rule("processing_latency", derived.LATENCY_METRIC, "GT", 30.0,
                                           5 * HOUR, HOUR)])
    return _alert_out(al.evaluate(_latency(spark, sf), rules))


@register
def alerts_error_rate(spark, sf):
    """H7: failed / (processed + failed) above 0.4 for 3 h."""
    pts = _points(spark, sf, error_rate=True)
    rules = al.rules_frame(spark, [al.rule("error_rate", mx.ERROR_RATE, "GT", 0.4, 3 * HOUR, HOUR)])
    return _alert_out(al.evaluate(pts, rules))


@register
def alerts_low_throughput(spark, sf):
    """H8: processed per hour below 8 for 3 h; hours without points count 0,
    from the first to the last message received."""
    rules = al.rules_frame(spark, [al.rule("low_throughput", mx.PROCESSED, "LT", 8.0, 3 * HOUR, HOUR,
                                           aligner="sum")])
    return _alert_out(al.evaluate(_points(spark, sf), rules, interval=derived.interval(spark, sf)))


@register
def alerts_multi_rule(spark, sf):
    """Several rules, different metrics, one evaluation; a rule without
    data (CPU) yields nothing."""
    allp = _points(spark, sf, error_rate=True).unionByName(_latency(spark, sf))
    rules = al.rules_frame(spark, [
        al.rule("processing_latency", derived.LATENCY_METRIC, "GT", 50.0, 3 * HOUR, HOUR),
        al.rule("end_to_end_latency", mx.E2E_LATENCY, "GT", 18.0, 2 * HOUR, HOUR, wired=False),
        al.rule("error_rate", mx.ERROR_RATE, "GT", 0.45, 2 * HOUR, HOUR),
        al.rule("low_throughput", mx.PROCESSED, "LT", 7.0, 2 * HOUR, HOUR, aligner="sum"),
        al.rule("high_cpu_usage", "gauge/cpu_usage", "GT", 80.0, 2 * HOUR, HOUR, wired=False),
    ])
    return _alert_out(al.evaluate(allp, rules, interval=derived.interval(spark, sf)))


# ---------------------------------------------------------------- streams


def _streamed(spark, df):
    """``df`` as files, read as a stream that takes them all at once: nothing is late, whatever the files' order."""
    path = store.at_path(spark, f"{uuid.uuid4().hex}/stream")
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path), path


def _finished(spark, start):
    """Run a stream to its end; stateful operators get a state store per core, not per shuffle partition of the session."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@register
def stream_alert_events(spark, sf):
    """H5 on a stream: alerts raised when the duration is full and cleared when the run ends, once each,
    up to the last watermark."""
    rules = al.rules_frame(spark, [al.rule("processing_latency", derived.LATENCY_METRIC, "GT", 20.0, 3 * HOUR, HOUR)])
    stream, path = _streamed(spark, _processed_latency(spark, sf))
    _finished(spark, lambda: held.start_held_alerts(
        stream, rules, f"{path}-alerts", checkpoint=f"{path}-checkpoint", lateness="300 seconds", available_now=True))
    out = spark.read.schema(held.ALERT_EVENTS).parquet(f"{path}-alerts")
    return out.select("rule", "series", "event", to_naive(F.col("start_time")).alias("start_time"),
                      to_naive(F.col("at")).alias("at"), "buckets")


@register
def ordered_delivery(spark, sf):
    """H16 on a stream: every key's messages in publish order, numbered, up to the last watermark."""
    msgs = derived.messages(spark, sf)
    stream, path = _streamed(spark, msgs)
    _finished(spark, lambda: ordered.start_delivery(
        stream, f"{path}-delivered", checkpoint=f"{path}-checkpoint", lateness="300 seconds", available_now=True))
    out = spark.read.parquet(f"{path}-delivered")
    return out.select("ordering_key", "delivery", "message_id", to_naive(F.col("publish_time")).alias("publish_time"))


# ---------------------------------------------------------------- runs


def _runs(spark, sf):
    return rn.run_summary(derived.hourly_runs(spark, sf), derived.outcomes(spark, sf),
                          _latency(spark, sf))


def _processed_runs(spark, sf):
    return rn.run_summary(derived.hourly_runs(spark, sf), derived.outcomes(spark, sf),
                          _processed_latency(spark, sf))


@register
def run_summary(spark, sf):
    """One 11-field record per hourly run."""
    r = _runs(spark, sf)
    return r.select(
        "test_name", to_naive(F.col("start_time")).alias("start_time"),
        to_naive(F.col("end_time")).alias("end_time"), "messages_sent", "messages_processed",
        _rd(F.col("avg_latency")).alias("avg_latency"), "p50_latency", "p95_latency", "p99_latency",
        "errors", F.round("throughput", 9).alias("throughput"))


@register
def run_results_loaded(spark, sf):
    """The run records saved as JSON Lines and loaded again."""
    path = store.at_path(spark, f"{uuid.uuid4().hex}/runs")
    results.save_results(_processed_runs(spark, sf), path)
    r = results.load_results(spark, path)
    return r.select("test_name", to_naive(F.col("start_time")).alias("start_time"), "messages_sent", "errors",
                    _rd(F.col("avg_latency")).alias("avg_latency"), "p99_latency")


@register
def run_analysis(spark, sf):
    """Totals, throughput stability, efficiency over all runs."""
    a = rn.run_analysis(_runs(spark, sf)).drop("latency_throughput_correlation")
    return a.select(*[_rd(F.col(c)).alias(c) if c.startswith(("avg", "max", "processing", "throughput"))
                      else F.col(c) for c in a.columns])


@register
def run_correlation(spark, sf):
    """Pearson correlation of throughput and mean latency across runs."""
    a = rn.run_analysis(_runs(spark, sf))
    return a.select(_rd(F.col("latency_throughput_correlation")).alias("correlation"))


@register
def high_error_runs(spark, sf):
    """Runs with errors."""
    return rn.high_error_runs(_processed_runs(spark, sf))


@register
def high_latency_runs(spark, sf):
    """Runs above mean + 1 population stddev of mean latency."""
    return rn.high_latency_runs(_runs(spark, sf))


@register
def latency_long(spark, sf):
    """G1: percentiles unpivoted."""
    return rn.latency_long(_runs(spark, sf))


@register
def efficiency_long(spark, sf):
    """Sent / processed unpivoted."""
    return rn.efficiency_long(_processed_runs(spark, sf))


@register
def throughput_errors(spark, sf):
    """Throughput and errors per run."""
    t = rn.throughput_errors(_processed_runs(spark, sf))
    return t.select("test_name", F.round("throughput", 9).alias("throughput"), "errors")


@register
def alerts_config_rules(spark, sf):
    """H9: the wired rules of the monitoring configuration as configured
    (60 s alignment, 300 s duration) over latency, error-rate and throughput points."""
    allp = _points(spark, sf, error_rate=True).unionByName(_processed_latency(spark, sf))
    wired = [r for r in al.CONFIG_RULES if r[7]]
    return _alert_out(al.evaluate(allp, al.rules_frame(spark, wired), interval=derived.interval(spark, sf)))


@register
def metric_catalog_usage(spark, sf):
    """The metric catalogue joined with the points actually produced."""
    pts = _points(spark, sf).unionByName(_processed_latency(spark, sf))
    return mx.catalog_usage(pts, mx.catalog_frame(spark))
