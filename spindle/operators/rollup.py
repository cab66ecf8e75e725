"""Mergeable rollups of metric points: per series and period a few numbers and a quantile sketch.

A row holds sum, count, minimum, maximum and a KLL sketch of its values; rows of a period merge into
rows of a longer one with the same figures as if those had been made from the points, the sketch within its error.
So a day's 99th percentile comes from 288 short rows of five minutes, not from the points. The rank error
of a sketch with ``k = 200`` is below ``RANK_ERROR`` for a single rank with 99 % confidence, however often it was merged;
up to ``k`` values are kept as they are.

The same functions serve a batch and a stream (append mode, with a watermark on the time column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.labels import series_key

SKETCH_K = 200
RANK_ERROR = 0.0133  # of one rank at k = 200, as the sketch's authors state it
SERIES = ("metric_type", "series")
FIGURES = ("sum", "n", "min", "max", "sketch")


def _window(time: Column | str, period_s: int) -> Column:
    return F.window(time, f"{int(period_s)} seconds")


def rollup(points: DataFrame, period_s: int, k: int = SKETCH_K) -> DataFrame:
    """Points -> (metric_type, series, w, sum, n, min, max, sketch); ``w`` is the window struct."""
    v = F.col("value")
    return (points.where(v.isNotNull())
            .groupBy("metric_type", series_key(F.col("labels")).alias("series"), _window("end_time", period_s).alias("w"))
            .agg(F.sum(v).alias("sum"), F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
                 F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")))


def coarser(rows: DataFrame, period_s: int, k: int = SKETCH_K) -> DataFrame:
    """Rows of ``rollup`` (or of this) -> rows of a longer period, which must be a multiple of theirs."""
    return (rows.groupBy("metric_type", "series", _window(F.window_time("w"), period_s).alias("w"))
            .agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
                 F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")))


def stored(rows: DataFrame) -> DataFrame:
    """What is written of a row: the window as its start (``bucket``), and the date of that."""
    return rows.select(*SERIES, F.col("w.start").alias("bucket"), *FIGURES, F.to_date("w.start").alias("date"))


def merge_stored(rows: DataFrame, by: Sequence[str] = SERIES, k: int = SKETCH_K) -> DataFrame:
    """Stored rows -> one row per group, whatever their periods."""
    return rows.groupBy(*by).agg(
        F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantiles(rows: DataFrame, ps: Sequence[float], by: Sequence[str] = SERIES) -> DataFrame:
    """(by.., p, value): approximate percentiles from the rows' sketches."""
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("p"),
                               F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(float(p))).alias("value"))
                      for p in ps])
    return rows.select(*by, F.inline(pairs))
