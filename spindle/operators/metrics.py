"""Metric points as a long table, and the rollups read from it.

Points are produced set-wise from the per-message outcome table (one row
per message -> 1..3 points via ``inline``), never one remote call per point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.labels import series_key
from spindle.functions.timefmt import bucket_start, seconds_between
from spindle.operators.envelope import stage_of
from spindle.operators.percentiles import approx_percentiles, exact_percentiles

# Metric name prefixes by kind (type path = prefix/name).
COUNTER, GAUGE, LATENCY, BATCH_SIZE = "counter", "gauge", "latency", "batch_size"
ERROR, SUCCESS = "counter/errors", "counter/successes"
RECEIVED = "counter/messages_received"
PROCESSED = "counter/messages_processed"
FAILED = "counter/messages_failed"
E2E_LATENCY = "latency/end_to_end_latency"
PROCESSING_LATENCY = "latency/processing_latency"
ERROR_RATE = "ratio/error_rate"
# Metric kind and value type that each kind of point is written with.
WRITTEN_AS = {
    COUNTER: ("CUMULATIVE", "INT64"), GAUGE: ("GAUGE", "DOUBLE"), LATENCY: ("GAUGE", "DOUBLE"),
    BATCH_SIZE: ("GAUGE", "INT64"), ERROR: ("CUMULATIVE", "INT64"), SUCCESS: ("CUMULATIVE", "INT64"),
}


# Metric catalogue of the monitoring configuration (name, declared kind, description).
CATALOG = [
    ("messages_received", "counter", "Number of messages received"),
    ("messages_processed", "counter", "Number of messages successfully processed"),
    ("messages_failed", "counter", "Number of messages that failed processing"),
    ("processing_latency", "gauge", "Message processing latency in seconds"),
    ("end_to_end_latency", "gauge", "End-to-end pipeline latency in seconds"),
    ("batch_size", "gauge", "Size of message batches"),
    ("batch_processing_time", "gauge", "Time taken to process each batch"),
    ("parsing_errors", "counter", "Number of message parsing errors"),
    ("validation_errors", "counter", "Number of message validation errors"),
    ("processing_errors", "counter", "Number of message processing errors"),
    ("storage_errors", "counter", "Number of storage operation errors"),
    ("cpu_usage", "gauge", "CPU usage percentage"),
    ("memory_usage", "gauge", "Memory usage percentage"),
    ("disk_usage", "gauge", "Disk usage percentage"),
]
STAGES = ("parsing", "validation", "processing", "storage")
# The dashboard's panels (column -> metric type and how a period's points become one value).
PANELS = {
    "messages_received": (RECEIVED, "sum"),
    "messages_processed": (PROCESSED, "sum"),
    "messages_failed": (FAILED, "sum"),
    "processing_latency": (PROCESSING_LATENCY, "mean"),
    "end_to_end_latency": (E2E_LATENCY, "mean"),
    **{f"{s}_errors": (f"counter/{s}_errors", "sum") for s in STAGES},
    **{f"{r}_usage": (f"gauge/{r}_usage", "mean") for r in ("cpu", "memory", "disk")},
}


def catalog_frame(spark) -> DataFrame:
    return spark.createDataFrame(CATALOG, "name string, declared_kind string, description string")


def metric_name(mtype: Column) -> Column:
    """Name part of a metric type path: 'latency/end_to_end_latency' -> 'end_to_end_latency'."""
    return F.regexp_extract(mtype, r"^[^/]+/(.*)$", 1)


def with_catalog(points: DataFrame, catalog: DataFrame) -> DataFrame:
    """Attach the declared kind of each point's metric (NULL when the
    metric is not in the catalogue). The catalogue is a fixed handful of
    rows, so it is broadcast."""
    return points.withColumn("name", metric_name(F.col("metric_type"))).join(
        F.broadcast(catalog), "name", "left")


def catalog_usage(points: DataFrame, catalog: DataFrame) -> DataFrame:
    """Points per catalogue metric (0 for declared metrics with no points);
    points are counted per name first, so only one row per name is joined."""
    per_name = points.groupBy(metric_name(F.col("metric_type")).alias("name")).agg(
        F.count(F.lit(1)).alias("n_points"))
    return (catalog.join(per_name, "name", "left")
            .select("name", "declared_kind", "description", F.coalesce("n_points", F.lit(0)).alias("n_points")))


def metric_type(kind: str, name: str) -> str:
    return f"{kind}/{name}"


def _map(d: dict[str, str]) -> Column:
    if not d:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def typed(value: Column, value_type: str) -> Column:
    """A point's value as its type writes it: INT64 drops the fraction, BOOL is whether it is not 0."""
    if value_type == "BOOL":
        return (value.cast("double") != 0).cast("double")
    if value_type not in ("INT64", "DOUBLE"):
        raise ValueError(f"unknown value type {value_type}")
    return value.cast("double") if value_type == "DOUBLE" else value.cast("bigint").cast("double")


# Spark type of each value type.
VALUE_TYPES = {"INT64": "bigint", "DOUBLE": "double", "BOOL": "boolean"}


def typed_points(df: DataFrame, points: Sequence[tuple[str, str, str, Column]], end_time: Column,
                 labels: dict[str, str] | None = None, resource: dict[str, str] | None = None) -> DataFrame:
    """Points whose values keep their type: per row one for each (metric type, metric kind, value type, value)
    whose value is not NULL, as ``schemas.TYPED_METRICS``. INT64 drops a fraction and is exact over all 64 bits,
    BOOL is whether a number is not 0."""
    rows = []
    for mtype, kind, value_type, value in points:
        if value_type not in VALUE_TYPES:
            raise ValueError(f"unknown value type {value_type}")
        value = value.cast(VALUE_TYPES[value_type])
        rows.append(F.when(value.isNotNull(), F.struct(
            F.lit(mtype).alias("metric_type"), F.lit(kind).alias("metric_kind"), F.lit(value_type).alias("value_type"),
            value.cast("variant").alias("value"))))
    return (df.select(F.inline(F.filter(F.array(*rows), lambda p: p.isNotNull())), end_time.alias("end_time"))
            .withColumn("labels", _map(labels or {})).withColumn("resource", _map(resource or {"type": "generic_task"}))
            .select("metric_type", "metric_kind", "value_type", "value", "labels", "resource", "end_time"))


def value_as(value_type: str) -> Column:
    """The value of a typed point, NULL for points of another type."""
    return F.when(F.col("value_type") == value_type, F.try_variant_get("value", "$", VALUE_TYPES[value_type]))


def untyped(points: DataFrame) -> DataFrame:
    """Typed points -> points with double values, which rollups and alerts take; BOOL is 1 or 0."""
    value = F.coalesce(value_as("DOUBLE"), value_as("INT64").cast("double"), value_as("BOOL").cast("double"))
    return points.withColumn("value", value)


def record(df: DataFrame, points: Sequence[tuple[str, str, Column | float]], end_time: Column,
           labels: Column | None = None, default_labels: dict[str, str] | None = None,
           resource: dict[str, str] | None = None) -> DataFrame:
    """Points of many rows at once: per row one for each (kind, name, value) whose value is not NULL.

    Kinds are those of ``WRITTEN_AS``: counters, gauges, latencies, batch sizes, and counted errors and
    successes by name. ``labels`` (a map column) win over the default labels.
    """
    base = _map(default_labels or {})
    own = base if labels is None else F.map_concat(base, F.coalesce(labels, _map({})))
    rows = []
    for kind, name, value in points:
        if kind not in WRITTEN_AS:
            raise ValueError(f"unknown kind of point {kind}")
        metric_kind, value_type = WRITTEN_AS[kind]
        value = typed(value if isinstance(value, Column) else F.lit(value), value_type)
        rows.append(F.when(value.isNotNull(), _point(f"{kind}/{name}", metric_kind, value_type, value, own)))
    return (df.select(F.inline(F.filter(F.array(*rows), lambda p: p.isNotNull())), end_time.alias("end_time"))
            .withColumn("resource", _map(resource or {"type": "generic_task"}))
            .select("metric_type", "metric_kind", "value_type", "value", "labels", "resource", "end_time"))


def _point(mtype: str | Column, kind: str, vtype: str, value: Column, labels: Column) -> Column:
    return F.struct(
        (F.lit(mtype) if isinstance(mtype, str) else mtype).alias("metric_type"),
        F.lit(kind).alias("metric_kind"),
        F.lit(vtype).alias("value_type"),
        value.cast("double").alias("value"),
        labels.alias("labels"),
    )


def outcome_points(outcomes: DataFrame, default_labels: dict[str, str] | None = None,
                   resource: dict[str, str] | None = None, error_rate: bool = False,
                   processing_time: Column | None = None) -> DataFrame:
    """Per message, received; on success processed, end-to-end latency and,
    where ``processing_time`` is given, processing latency; on failure failed, the counter of the
    stage that failed (``counter/<stage>_errors``) and ``counter/errors/<reason>``. With ``error_rate`` every
    message also gives a ``ratio/error_rate`` point, 1 if failed, else 0: its mean over a
    period is failed / (processed + failed), found in the same pass.

    Default labels are merged under every point's labels (point labels win).
    """
    base = _map(default_labels or {})
    reason = F.col("reject_reason")
    ok = reason.isNull()
    one = F.lit(1)
    latency = seconds_between(F.col("timestamp"), F.col("processing_timestamp"))
    err_labels = F.map_concat(base, F.create_map(F.lit("reason"), F.coalesce(reason, F.lit(""))))
    points = F.array(
        _point(RECEIVED, "CUMULATIVE", "INT64", one, base),
        F.when(ok, _point(PROCESSED, "CUMULATIVE", "INT64", one, base)),
        F.when(ok, _point(E2E_LATENCY, "GAUGE", "DOUBLE", latency, base)),
        *([F.when(ok, _point(PROCESSING_LATENCY, "GAUGE", "DOUBLE", processing_time, base))]
          if processing_time is not None else []),
        F.when(~ok, _point(FAILED, "CUMULATIVE", "INT64", one, base)),
        F.when(~ok, _point(F.concat(F.lit("counter/"), stage_of(reason), F.lit("_errors")), "CUMULATIVE", "INT64", one,
                           base)),
        F.when(~ok, _point(F.concat(F.lit("counter/errors/"), reason), "CUMULATIVE", "INT64", one,
                           err_labels)),
        *([_point(ERROR_RATE, "GAUGE", "DOUBLE", F.when(ok, 0).otherwise(1), base)] if error_rate else []),
    )
    return (
        outcomes.select(F.inline(F.filter(points, lambda p: p.isNotNull())),
                        F.col("publish_time").alias("end_time"))
        .withColumn("resource", _map(resource or {"type": "generic_task"}))
        .select("metric_type", "metric_kind", "value_type", "value", "labels", "resource", "end_time")
    )


def scan(metrics: DataFrame, metric_type_: str, start: str | None = None, end: str | None = None,
         resource_type: str | None = None) -> DataFrame:
    """Points of one exact type in [start, end], all series."""
    cond = F.col("metric_type") == F.lit(metric_type_)
    if start is not None:
        cond = cond & (F.col("end_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        cond = cond & (F.col("end_time") <= F.lit(end).cast("timestamp"))
    if resource_type is not None:
        cond = cond & (F.col("resource")["type"] == F.lit(resource_type))
    return metrics.where(cond)


def with_series(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("series", series_key(F.col("labels")))


def stats(metrics: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """D3: count and mean per group (mean 0.0 for a requested group with no points
    is the caller's left join + coalesce)."""
    return metrics.groupBy(*group_cols).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"))


def percentiles(metrics: DataFrame, group_cols: Sequence[str], ps: Sequence[float],
                exact: bool = True) -> DataFrame:
    """Floor-index percentiles (exact) or ``percentile_approx``."""
    fn = exact_percentiles if exact else approx_percentiles
    return fn(metrics, group_cols, "value", ps)


def aligned(metrics: DataFrame, period_s: int, aligner: str = "mean",
            group_cols: Sequence[str] = ("metric_type", "series")) -> DataFrame:
    """One value per series per alignment period."""
    agg = {
        "mean": F.avg("value"), "sum": F.sum("value"), "count": F.count("value"),
        "max": F.max("value"), "min": F.min("value"),
        "rate": F.sum("value") / F.lit(float(period_s)),
    }[aligner]
    return (metrics.groupBy(*group_cols, bucket_start(F.col("end_time"), period_s).alias("bucket"))
            .agg(agg.alias("value"), F.count(F.lit(1)).alias("n")))


def outcome_counts(outcomes: DataFrame, period_s: int, time_col: str = "publish_time") -> DataFrame:
    """Received / processed / failed per period, one pass."""
    ok = F.col("reject_reason").isNull()
    return (outcomes.groupBy(bucket_start(F.col(time_col), period_s).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("received"), F.count_if(ok).alias("processed"),
                 F.count_if(~ok).alias("failed")))


def errors_by_stage(rejects: DataFrame) -> DataFrame:
    """Error counters by stage (parsing, validation, processing, storage)."""
    return rejects.groupBy(stage_of(F.col("reject_reason")).alias("stage")).agg(
        F.count(F.lit(1)).alias("n"))


def batch_stats(outcomes: DataFrame, batch_col: Column | None = None,
                time_col: str = "publish_time") -> DataFrame:
    """Batch size and batch time span per batch id."""
    b = batch_col if batch_col is not None else F.col("attributes")["batch_id"]
    t = F.col(time_col)
    return outcomes.groupBy(b.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("batch_size"),
        seconds_between(F.min(t), F.max(t)).alias("span_s"),
    )


def error_rate_points(points: DataFrame, period_s: int) -> DataFrame:
    """Error ratio per series and period, as metric points of ``ratio/error_rate``:
    failed / (processed + failed)."""
    is_failed = F.col("metric_type") == F.lit(FAILED)
    is_done = F.col("metric_type").isin(PROCESSED, FAILED)
    series_labels = F.col("labels")
    per = (points.where(is_done)
           .groupBy(series_labels.alias("labels"),
                    bucket_start(F.col("end_time"), period_s).alias("end_time"))
           .agg(F.sum(F.when(is_failed, F.col("value")).otherwise(0.0)).alias("_f"),
                F.sum("value").alias("_t")))
    return per.select(
        F.lit(ERROR_RATE).alias("metric_type"), F.lit("GAUGE").alias("metric_kind"),
        F.lit("DOUBLE").alias("value_type"),
        F.try_divide(F.col("_f"), F.col("_t")).alias("value"),
        "labels", _map({"type": "generic_task"}).alias("resource"), "end_time",
    )


def dashboard(points: DataFrame, period_s: int, panels: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per period, one column per panel.

    ``panels`` maps column name -> (metric_type, aggregate in {sum, mean, count}).
    The pivot values are given explicitly, so no extra pass finds them.
    """
    types = sorted({t for t, _ in panels.values()})
    bucket = bucket_start(F.col("end_time"), period_s).alias("bucket")
    wide = (points.where(F.col("metric_type").isin(types))
            .groupBy(bucket).pivot("metric_type", types)
            .agg(F.sum("value").alias("sum"), F.count("value").alias("count")))
    cols = [F.col("bucket")]
    for name, (t, how) in panels.items():
        s, c = F.col(f"`{t}_sum`"), F.col(f"`{t}_count`")
        expr = {"sum": F.coalesce(s, F.lit(0.0)), "count": F.coalesce(c, F.lit(0)),
                "mean": F.try_divide(s, c)}[how]
        cols.append(expr.alias(name))
    return wide.select(*cols)
