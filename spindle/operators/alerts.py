"""Threshold alert rules held for a whole duration, per series.

A rule (metric type, aligner, comparison, threshold, duration, period) is a
row of a small rules table. Evaluation:
  points -> aligned per metric type, series and period -> join rules -> one
  value per (rule, series, bucket) -> breach flag -> consecutive breaching buckets
  (gaps and islands: bucket - period * row_number is constant within a run)
  -> runs lasting at least ``duration``.
Windows run over aligned buckets, never raw points. Missing buckets end a
run for GT rules; for LT rules (low throughput) a missing bucket counts 0.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindle.functions.labels import series_key
from spindle.functions.timefmt import bucket_start
from spindle.operators.joins import broadcast_if_small
from spindle.schemas import ALERT_RULES
from spindle.session import materialize

# Alert rules of the monitoring configuration
# (rule, metric_type, aligner, comparison, threshold, duration_s, period_s, wired, resource_type).
MAX_BROADCAST_RULES = 100_000
DEFAULT_DURATION_S = 300
DEFAULT_PERIOD_S = 60
CONFIG_RULES = [
    ("processing_latency", "latency/processing_latency", "mean", "GT", 5.0, 300, 60, True, "generic_task"),
    ("end_to_end_latency", "latency/end_to_end_latency", "mean", "GT", 10.0, 300, 60, False, "generic_task"),
    ("error_rate", "ratio/error_rate", "mean", "GT", 0.01, 300, 60, True, "generic_task"),
    ("low_throughput", "counter/messages_processed", "sum", "LT", 100.0, 300, 60, True, "generic_task"),
    ("high_cpu_usage", "gauge/cpu_usage", "mean", "GT", 80.0, 300, 60, False, "generic_task"),
    ("high_memory_usage", "gauge/memory_usage", "mean", "GT", 80.0, 300, 60, False, "generic_task"),
    ("high_disk_usage", "gauge/disk_usage", "mean", "GT", 80.0, 300, 60, False, "generic_task"),
]


def rules_frame(spark: SparkSession, rules: Iterable[tuple]) -> DataFrame:
    """Rules table; a rule without a resource type (8 fields) matches any resource."""
    n = len(ALERT_RULES.fields)
    return spark.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rules], ALERT_RULES)


def rule(name: str, metric_type: str, comparison: str, threshold: float,
         duration_s: int = DEFAULT_DURATION_S, period_s: int = DEFAULT_PERIOD_S,
         aligner: str = "mean", wired: bool = True, resource_type: str | None = None) -> tuple:
    if comparison not in ("GT", "LT"):
        raise ValueError("comparison must be GT or LT")
    if int(period_s) <= 0 or int(duration_s) < 0:
        raise ValueError("period_s must be positive and duration_s non-negative")
    if aligner not in ("mean", "sum", "count", "rate", "max", "min"):
        raise ValueError(f"unknown aligner {aligner}")
    return (name, metric_type, aligner, comparison, float(threshold), int(duration_s),
            int(period_s), wired, resource_type)


def match_rules(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Points of each rule: same metric type and, when the rule names one, the
    same resource type (``metric.type = .. AND resource.type = ..``)."""
    joined = points.join(rules, "metric_type")
    rtype = F.col("resource_type")
    return joined.where(rtype.isNull() | (F.col("resource")["type"] == rtype)).drop("resource_type")


def aligned_value() -> Column:
    """The aggregate that the rule's aligner names."""
    aligner = F.col("aligner")
    return (
        F.when(aligner == "mean", F.avg("value"))
        .when(aligner == "sum", F.sum("value"))
        .when(aligner == "count", F.count("value").cast("double"))
        .when(aligner == "rate", F.sum("value") / F.col("period_s"))
        .when(aligner == "max", F.max("value"))
        .when(aligner == "min", F.min("value"))
    )


def aligned_by_rule(points: DataFrame, rules: DataFrame) -> DataFrame:
    """One value per (rule, series, bucket) using each rule's own period and aligner.

    Points are aligned first, per metric type and period that any rule asks for, and
    the rules are joined to the aligned rows only. The rules table is configuration: its
    distinct (metric type, period) pairs become a literal of the plan, and the table
    itself is broadcast after a bounded size check.
    """
    periods: dict[str, list[int]] = {}
    for r in rules.select("metric_type", "period_s").distinct().collect():
        periods.setdefault(r["metric_type"], []).append(r["period_s"])
    if not periods:
        asked = F.array().cast("array<int>")
    else:
        asked = F.create_map(*[x for t, of in sorted(periods.items())
                               for x in (F.lit(t), F.array(*[F.lit(p) for p in sorted(of)]))])[F.col("metric_type")]
    v = F.col("value")
    per = (points.where(F.col("metric_type").isin(list(periods)))
           .select("metric_type", F.col("resource")["type"].alias("of_type"), "labels", "end_time", "value",
                   F.explode(asked).alias("period_s"))
           .groupBy("metric_type", "of_type", "labels", "period_s",
                    bucket_start(F.col("end_time"), F.col("period_s")).alias("bucket"))
           .agg(F.sum(v).alias("_sum"), F.count(v).alias("_n"), F.max(v).alias("_max"), F.min(v).alias("_min")))
    joined = per.join(broadcast_if_small(rules, MAX_BROADCAST_RULES), ["metric_type", "period_s"]).where(
        F.col("resource_type").isNull() | (F.col("of_type") == F.col("resource_type")))
    aligner, total, n = F.col("aligner"), F.sum("_sum"), F.sum("_n")
    value = (F.when(aligner == "mean", F.try_divide(total, n))
             .when(aligner == "sum", total)
             .when(aligner == "count", n.cast("double"))
             .when(aligner == "rate", total / F.col("period_s"))
             .when(aligner == "max", F.max("_max"))
             .when(aligner == "min", F.min("_min")))
    # aligner and period_s depend on the rule only; grouping on them keeps
    # them available to the aggregate expression.
    return (joined.groupBy("rule", "aligner", "period_s", series_key(F.col("labels")).alias("series"), "bucket")
            .agg(value.alias("value")).drop("aligner", "period_s"))


def _islands(a: DataFrame) -> DataFrame:
    """Runs of consecutive breaching buckets (present rows only)."""
    breach = F.when(F.col("comparison") == "GT", F.col("value") > F.col("threshold")) \
        .otherwise(F.col("value") < F.col("threshold"))
    b = a.where(breach)
    order = Window.partitionBy("rule", "series").orderBy("bucket")
    b = b.withColumn("_island", F.unix_seconds("bucket") - F.col("period_s") * F.row_number().over(order))
    return (b.groupBy("rule", "series", "_island", "period_s", "duration_s")
            .agg(F.min("bucket").alias("start_time"), F.max("bucket").alias("_last"),
                 F.count(F.lit(1)).alias("buckets"))
            .withColumn("end_time", F.timestamp_seconds(F.unix_seconds("_last") + F.col("period_s"))))


def _gaps(a: DataFrame, rules: DataFrame, interval: tuple[int, int] | None) -> DataFrame:
    """LT rules where a missing bucket (0) breaches: runs are the gaps between
    non-breaching buckets, within the evaluated interval (epoch seconds of its
    first and last moment), else the rule's own [first, last] bucket span. With an
    interval, a rule without any point is one empty series.

    Two sentinels per series (one period outside the span) close the ends.
    One window over non-breaching rows; no grid of every bucket is built.
    """
    keys = a.select("rule", "series", "period_s", "duration_s").distinct()
    if interval is None:
        span = a.groupBy("rule").agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi"))
        keys = keys.join(span, "rule")
    else:
        silent = rules.join(keys.select("rule").distinct(), "rule", "left_anti")
        keys = keys.unionByName(silent.select("rule", F.lit("{}").alias("series"), "period_s", "duration_s"))
        bound = lambda s: F.timestamp_seconds(F.floor(F.lit(int(s)) / F.col("period_s")) * F.col("period_s"))
        keys = keys.withColumn("_lo", bound(interval[0])).withColumn("_hi", bound(interval[1]))
    p = F.col("period_s")
    sentinels = keys.select(
        "rule", "series", "period_s", "duration_s",
        F.explode(F.array(F.unix_seconds("_lo") - p, F.unix_seconds("_hi") + p)).alias("_s"))
    ok = a.where(F.col("value") >= F.col("threshold")).select(
        "rule", "series", "period_s", "duration_s", F.unix_seconds("bucket").alias("_s"))
    marks = ok.unionByName(sentinels)
    order = Window.partitionBy("rule", "series").orderBy("_s")
    gaps = marks.withColumn("_prev", F.lag("_s").over(order)).where(F.col("_prev").isNotNull())
    gaps = gaps.withColumn("buckets", ((F.col("_s") - F.col("_prev")) / p).cast("long") - 1)
    return gaps.where(F.col("buckets") >= 1).select(
        "rule", "series", "period_s", "duration_s",
        F.timestamp_seconds(F.col("_prev") + p).alias("start_time"),
        F.timestamp_seconds(F.col("_s")).alias("end_time"), "buckets")


def breach_runs(aligned: DataFrame, rules: DataFrame, min_duration: bool = True,
                fill_lt: bool = True, interval: tuple[int, int] | None = None) -> DataFrame:
    """Consecutive breaching buckets per (rule, series) -> runs.

    Output: rule, series, start_time, end_time (end of last bucket), buckets.
    With ``fill_lt`` an LT rule with a positive threshold treats a missing
    bucket as 0, i.e. as breaching, throughout ``interval`` (epoch seconds of
    the first and last moment evaluated). Without an interval only the span of the rule's own
    points is known, so an outage at either end goes unseen.
    """
    r = broadcast_if_small(rules.select("rule", "comparison", "threshold", "duration_s", "period_s"),
                           MAX_BROADCAST_RULES)
    a = aligned.join(r, "rule")
    filled = (F.col("comparison") == "LT") & (F.col("threshold") > 0) if fill_lt else F.lit(False)
    fills = a.where(filled)
    if interval is not None:  # only what is filled has an interval; other rules keep their edge buckets
        fills = fills.where(F.unix_seconds("bucket").between(
            F.floor(F.lit(int(interval[0])) / F.col("period_s")) * F.col("period_s"), int(interval[1])))
    runs = _islands(a.where(~filled)).drop("_island", "_last").unionByName(
        _gaps(fills, r.where(filled), interval))
    if min_duration:
        runs = runs.where(F.col("buckets") * F.col("period_s") >= F.col("duration_s"))
    return runs.select("rule", "series", "start_time", "end_time", "buckets")


def evaluate(points: DataFrame, rules: DataFrame, checkpoint: bool = True,
             interval: tuple[int, int] | None = None) -> DataFrame:
    """Full rule evaluation: align per rule, then sustained breaches (LT gaps count 0).

    The aligned table (one row per rule, series and bucket: far smaller than
    the points) is read by several branches of the run detection, so it is
    written once to the checkpoint folder instead of being re-derived from
    the points per branch.
    """
    aligned = aligned_by_rule(points, rules)
    if checkpoint:
        aligned = materialize(aligned)
    return breach_runs(aligned, rules, interval=interval)
