"""Run statistics: sent vs processed, per-run summary, cross-run analysis.

A run is a row (test_name, start_time, end_time). Facts (messages, metric
points) are attached to runs by an interval join written as an equi-join:
each run is exploded into the hour bins it overlaps, facts carry their hour
bin, and the exact [start, end) test is a filter after the join. No nested
loop, and a run spanning many hours only adds bins, not pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.timefmt import seconds_between
from spindle.operators.joins import broadcast_if_small
from spindle.operators.percentiles import exact_percentiles

BIN = "INTERVAL 1 HOUR"


def _run_bins(runs: DataFrame) -> DataFrame:
    last = F.col("end_time") - F.expr("INTERVAL 1 MICROSECOND")
    return runs.select(
        "test_name", "start_time", "end_time",
        F.explode(F.sequence(F.date_trunc("hour", "start_time"), F.date_trunc("hour", last),
                             F.expr(BIN))).alias("_bin"),
    )


def attach_runs(facts: DataFrame, runs: DataFrame, time_col: str,
                max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Facts inside [start_time, end_time) of each run, with the run's name."""
    bins = broadcast_if_small(_run_bins(runs), max_broadcast_rows)
    # The fact time is carried as ``_t`` so fact columns may share run column names.
    f = facts.withColumnRenamed(time_col, "_t")
    t = F.col("_t")
    return (f.withColumn("_bin", F.date_trunc("hour", t))
            .join(bins, "_bin")
            .where((t >= F.col("start_time")) & (t < F.col("end_time")))
            .drop("_bin", "start_time", "end_time")
            .withColumnRenamed("_t", time_col))


def message_counts(outcome_table: DataFrame, start: str, end: str,
                   batch_id: str | None = None) -> DataFrame:
    """Sent (rows in range) and processed (rows with processing_timestamp) in one pass.

    The range is inclusive on both ends; ``batch_id`` adds an optional conjunct.
    """
    cond = F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    if batch_id is not None:
        cond = cond & (F.col("batch_id") == F.lit(batch_id))
    return outcome_table.where(cond).agg(
        F.count(F.lit(1)).alias("sent"), F.count("processing_timestamp").alias("processed"))


def run_summary(runs: DataFrame, outcomes: DataFrame, latency_points: DataFrame,
                ps: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """The 11-field run record, one row per run (empty runs give 0s)."""
    msgs = attach_runs(outcomes.select("publish_time", "reject_reason"), runs, "publish_time")
    ok = F.col("reject_reason").isNull()
    counts = msgs.groupBy("test_name").agg(
        F.count(F.lit(1)).alias("messages_sent"),
        F.count_if(ok).alias("messages_processed"),
        F.count_if(~ok).alias("errors"),
    )
    lat = attach_runs(latency_points.select("end_time", "value"), runs, "end_time")
    mean = lat.groupBy("test_name").agg(F.avg("value").alias("avg_latency"))
    pct = exact_percentiles(lat, ["test_name"], "value", ps)
    names = {p: f"p{int(round(p * 100))}_latency" for p in ps}
    pct_wide = pct.groupBy("test_name").agg(*[
        F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(n) for p, n in names.items()
    ])
    dur = seconds_between(F.col("start_time"), F.col("end_time"))
    out = (runs.join(counts, "test_name", "left").join(mean, "test_name", "left")
           .join(pct_wide, "test_name", "left"))
    zero = F.lit(0.0)
    return out.select(
        "test_name", "start_time", "end_time",
        F.coalesce("messages_sent", F.lit(0)).cast("long").alias("messages_sent"),
        F.coalesce("messages_processed", F.lit(0)).cast("long").alias("messages_processed"),
        F.coalesce("avg_latency", zero).alias("avg_latency"),
        *[F.coalesce(n, zero).alias(n) for n in names.values()],
        F.coalesce("errors", F.lit(0)).cast("long").alias("errors"),
        F.when(dur > 0, F.coalesce("messages_processed", F.lit(0)) / dur).otherwise(zero).alias("throughput"),
    )


def _pearson(x: Column, y: Column) -> Column:
    """Population Pearson r; NULL when a side is constant (no ANSI divide error)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def run_analysis(runs: DataFrame) -> DataFrame:
    """One row of cross-run figures."""
    sent, processed = F.sum("messages_sent"), F.sum("messages_processed")
    avg_tp, std_tp = F.avg("throughput"), F.stddev_pop("throughput")
    return runs.agg(
        F.count(F.lit(1)).alias("total_tests"),
        sent.cast("long").alias("total_messages_sent"),
        processed.cast("long").alias("total_messages_processed"),
        F.sum("errors").cast("long").alias("total_errors"),
        avg_tp.alias("avg_throughput"),
        F.max("throughput").alias("max_throughput"),
        F.avg("avg_latency").alias("avg_latency"),
        F.coalesce(F.try_divide(processed, F.nullif(sent, F.lit(0))) * 100.0, F.lit(0.0))
        .alias("processing_efficiency"),
        std_tp.alias("throughput_std"),
        F.when(avg_tp > 0, std_tp / avg_tp).otherwise(F.lit(0.0)).alias("throughput_cv"),
        _pearson(F.col("throughput"), F.col("avg_latency")).alias("latency_throughput_correlation"),
    )


def high_error_runs(runs: DataFrame) -> DataFrame:
    """Runs with any error."""
    return runs.where(F.col("errors") > 0).select("test_name")


def high_latency_runs(runs: DataFrame) -> DataFrame:
    """Runs whose mean latency exceeds mean + population stddev (strict).

    The bound is a scalar subquery: one aggregate row, no join.
    """
    bound = runs.select(F.avg("avg_latency") + F.stddev_pop("avg_latency")).scalar()
    return runs.where(F.col("avg_latency") > bound).select("test_name")


def latency_long(runs: DataFrame) -> DataFrame:
    """G1: run x {P50, P95, P99} -> latency."""
    return runs.select(
        "test_name", F.col("p50_latency").alias("P50"), F.col("p95_latency").alias("P95"),
        F.col("p99_latency").alias("P99"),
    ).unpivot("test_name", ["P50", "P95", "P99"], "percentile", "latency")


def efficiency_long(runs: DataFrame) -> DataFrame:
    """Run x {Sent, Processed} -> count."""
    return runs.select(
        "test_name", F.col("messages_sent").alias("Sent"),
        F.col("messages_processed").alias("Processed"),
    ).unpivot("test_name", ["Sent", "Processed"], "kind", "count")


def throughput_errors(runs: DataFrame) -> DataFrame:
    """Throughput and errors per run."""
    return runs.select("test_name", "throughput", "errors")
