"""Exact floor-index percentiles at scale.

Semantics: for n sorted values and 0 <= p < 1 the answer is ``sorted[int(n*p)]``
(no interpolation; differs from ``percentile`` and ``percentile_disc``).

Plan, chosen so that no row travels before its bucket is known:
1. Every value gets a monotone coarse bucket (sign, decade and three
   significant digits, ~9000 buckets per decade). Counts, least and greatest
   value per (group, bucket) are combined map-side, and a running sum over
   that small histogram places the target rank ``k = floor(n*p) + 1`` in one bucket.
2. While a located bucket holds more than ``sliver_rows`` rows of differing
   values, the span between its least and greatest value is cut into
   ``PARTS`` equal parts and located again. A round shortens the span by that
   factor, so a handful of rounds reaches single values.
3. Only the rows of the located spans are shuffled, combined by value, and ranked.
The located buckets (one short row per group and p) are checkpointed between
steps and broadcast after a size check; larger ones are joined by the planner. A group
with a third of all rows costs histogram rows only, plus its slivers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.operators.joins import broadcast_if_small
from spindle.session import materialize

SLIVER_ROWS = 100_000  # rows of a located span that one task may rank
PARTS = 4096  # parts of a span that holds more


def coarse_bucket(v: Column) -> Column:
    """Monotone non-decreasing integer key of a double (0 for 0.0).

    Sign, decade and three significant digits. The divisor's exponent is
    clamped so subnormal values cannot divide by an underflowed 0; -Inf, +Inf
    and NaN get the outermost keys (Spark orders NaN above +Inf).
    """
    a = F.abs(v)
    e = F.floor(F.log10(a))
    m = F.floor(a / F.pow(F.lit(10.0), F.greatest(e, F.lit(-300))) * F.lit(1000.0))
    mag = (e + F.lit(400)) * F.lit(10001) + m
    big = F.lit(10_000_000)
    key = (
        F.when(F.isnan(v), big + 2)
        .when(v == F.lit(float("inf")), big + 1)
        .when(v == F.lit(float("-inf")), -big - 1)
        .when(v > 0, mag).when(v < 0, -mag).otherwise(F.lit(0))
    )
    return F.coalesce(key.cast("long"), F.lit(0))


def _locate(hist: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """For each ``keys`` group with a target rank ``_k``, keep the ``order_col`` bucket
    holding it, with the residual rank inside that bucket."""
    running = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = F.col("_cum") - F.col("_n")
    h = hist.withColumn("_cum", F.sum("_n").over(running))
    return (h.where((before < F.col("_k")) & (F.col("_k") <= F.col("_cum")))
            .withColumn("_k", F.col("_k") - before).drop("_cum"))


def _span() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      ps: Sequence[float], p_col: str = "p", out_col: str = "value",
                      sliver_rows: int = SLIVER_ROWS) -> DataFrame:
    """One row per (group, p) with the floor-index percentile; empty groups are absent."""
    for p in ps:
        if not 0.0 <= p < 1.0:
            raise ValueError(f"percentile {p} outside [0, 1)")
    g = list(group_cols)
    vals = (df.where(F.col(value_col).isNotNull()).select(*g, F.col(value_col).alias("_v"))
            .withColumn("_b", coarse_bucket(F.col("_v"))))
    hist = vals.groupBy(*g, "_b").agg(*_span())
    hist = (hist.withColumn("_all", F.sum("_n").over(Window.partitionBy(*g)))
            .withColumn(p_col, F.explode(F.array(*[F.lit(float(p)) for p in ps])))
            .withColumn("_k", F.floor(F.col("_all") * F.col(p_col)).cast("long") + F.lit(1)).drop("_all"))
    spans = materialize(_locate(hist, [*g, p_col], "_b"))

    def within() -> DataFrame:
        """The rows of the located spans, once per p."""
        located = broadcast_if_small(spans.drop("_n"))
        return vals.join(located, [*g, "_b"]).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))

    while not spans.where((F.col("_n") > sliver_rows) & (F.col("_lo") < F.col("_hi"))).isEmpty():
        share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        part = F.when(F.col("_lo") < F.col("_hi"), F.floor(share * PARTS)).otherwise(F.lit(0))
        finer = within().withColumn("_part", part).groupBy(*g, p_col, "_b", "_k", "_part").agg(*_span())
        spans = materialize(_locate(finer, [*g, p_col], "_part").drop("_part"))

    pick = Window.partitionBy(*g, p_col).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (within().groupBy(*g, p_col, "_k", "_v").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_cc", F.sum("_c").over(pick)))
    return (ranked.where((F.col("_cc") >= F.col("_k")) & (F.col("_cc") - F.col("_c") < F.col("_k")))
            .select(*g, p_col, F.col("_v").alias(out_col)))


def approx_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                       ps: Sequence[float], accuracy: int = 10000, p_col: str = "p",
                       out_col: str = "value") -> DataFrame:
    """Approximate form (one aggregation, mergeable sketches); rank error ~ 1/accuracy."""
    arr = F.percentile_approx(value_col, [float(p) for p in ps], accuracy)
    return (
        df.groupBy(*group_cols)
        .agg(arr.alias("_q"))
        .select(*group_cols, F.inline(F.arrays_zip(
            F.array(*[F.lit(float(p)) for p in ps]).alias(p_col), F.col("_q").alias(out_col))))
    )
