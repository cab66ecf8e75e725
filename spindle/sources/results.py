"""Run-result files: JSON Lines out, JSON (lines or array) in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.timefmt import iso_text
from spindle.schemas import RUNS

_TS_FIELDS = ("start_time", "end_time")


def save_results(runs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write runs as JSON Lines with ISO-8601 UTC timestamps."""
    out = runs.select(*[
        iso_text(F.col(c)).alias(c) if c in _TS_FIELDS else F.col(c) for c in runs.columns
    ])
    out.write.mode(mode).json(path)


def load_results(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read run results; ISO text -> TIMESTAMP with try_cast (bad text -> NULL)."""
    text_schema = ", ".join(
        f"{f.name} STRING" if f.name in _TS_FIELDS else f"{f.name} {f.dataType.simpleString()}"
        for f in RUNS.fields
    )
    raw = spark.read.schema(text_schema).option("multiLine", str(multiline).lower()).json(path)
    return raw.select(*[
        F.col(c).try_cast("timestamp").alias(c) if c in _TS_FIELDS else F.col(c)
        for c in raw.columns
    ])


def save_analysis(runs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the cross-run analysis: ``summary`` (one JSON row of figures) and
    the bottleneck lists ``high_error_runs`` / ``high_latency_runs`` as their
    own JSON Lines tables (rows, not arrays, so no list is gathered in one row)."""
    from spindle.operators import runs as rn

    rn.run_analysis(runs).write.mode(mode).json(f"{path}/summary")
    rn.high_error_runs(runs).write.mode(mode).json(f"{path}/high_error_runs")
    rn.high_latency_runs(runs).write.mode(mode).json(f"{path}/high_latency_runs")
