"""Queries over the latency points take the points of all events, those of failing messages too."""

import pytest

from spindle.plans import catalog

VIEW = '{"environment":"test","event_type":"view","service":"spindle"}'
MEANS = [55.0] * 5 + [140.0]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Six hours, each with a message that is processed (value 10) and one that fails (100, in the last hour 400);
    the last hour has another one that is processed."""
    rows = [row for h in range(6) for row in ((20 * h + 8, h, 10.0), (20 * h + 1, h, 400.0 if h == 5 else 100.0))]
    path = str(tmp_path_factory.mktemp("points"))
    (spark.createDataFrame([*rows, (109, 5, 10.0)], "event_id long, h int, value double")
     .selectExpr("event_id", "cast(timestamp_ntz'2024-01-10 00:05:00' + make_dt_interval(0, h) as timestamp_ntz) as ts",
                 "event_id as user_id", "'view' as event_type", "value", "'{}' as props")
     .write.parquet(f"{path}/events.parquet"))
    return path


def _rows(spark, table, name, *columns):
    return [tuple(r) for r in catalog.REGISTRY[name](spark, table).select(*columns).orderBy(*columns).collect()]


def test_metric_scan(spark, table):
    assert [v for v, in _rows(spark, table, "metric_scan", "value")] == [10.0] * 7 + [100.0] * 5 + [400.0]


def test_metric_stats(spark, table):
    got = {r[0]: r[1:] for r in _rows(spark, table, "metric_stats", "event_type", "n", "mean")}
    assert got["view"] == (13, 74.615384615) and got["refund"] == (0, 0.0)


def test_metric_percentiles(spark, table):
    assert _rows(spark, table, "metric_percentiles", "p", "value") == [(0.5, 10.0), (0.95, 400.0), (0.99, 400.0)]


def test_aligned_mean(spark, table):
    assert [r[1:] for r in _rows(spark, table, "aligned_mean", "bucket", "mean", "n")] == [*zip(MEANS, [2] * 5 + [3])]


def test_alerts_latency(spark, table):
    assert _rows(spark, table, "alerts_latency", "rule", "series", "buckets") == [("processing_latency", VIEW, 6)]


def test_alerts_multi_rule(spark, table):
    assert ("processing_latency", VIEW, 6) in _rows(spark, table, "alerts_multi_rule", "rule", "series", "buckets")


def test_run_summary(spark, table):
    got = _rows(spark, table, "run_summary", "start_time", "avg_latency", "p50_latency", "p95_latency", "p99_latency")
    assert [r[1:] for r in got] == [(55.0, 100.0, 100.0, 100.0)] * 5 + [(140.0, 10.0, 400.0, 400.0)]


def test_run_analysis(spark, table):
    assert _rows(spark, table, "run_analysis", "total_tests", "avg_latency") == [(6, 69.166666667)]


def test_run_correlation(spark, table):
    assert _rows(spark, table, "run_correlation", "correlation") == [(1.0,)]


def test_high_latency_runs(spark, table):
    assert _rows(spark, table, "high_latency_runs", "test_name") == [("run-2024011005",)]


def test_latency_long(spark, table):
    got = _rows(spark, table, "latency_long", "percentile", "latency")
    assert got == [("P50", 10.0)] + [("P50", 100.0)] * 5 + [("P95", 100.0)] * 5 + [("P95", 400.0)] \
        + [("P99", 100.0)] * 5 + [("P99", 400.0)]
