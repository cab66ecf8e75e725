import datetime as dt

import pytest

from spindle.operators import runs as rn
from spindle.schemas import RUNS

T0 = dt.datetime(2024, 1, 1)


def runs_df(spark, rows):
    full = [(f"r{i}", T0, T0 + dt.timedelta(hours=1), s, p, lat, lat, lat, lat, e, tp)
            for i, (s, p, lat, e, tp) in enumerate(rows)]
    return spark.createDataFrame(full, RUNS)


def test_analysis_values(spark):
    df = runs_df(spark, [(10, 8, 1.0, 0, 2.0), (10, 10, 3.0, 2, 4.0)])
    a = rn.run_analysis(df).collect()[0]
    assert a.total_tests == 2 and a.total_messages_sent == 20 and a.total_errors == 2
    assert a.processing_efficiency == pytest.approx(90.0)
    assert a.throughput_std == pytest.approx(1.0)  # population stddev
    assert a.throughput_cv == pytest.approx(1.0 / 3.0)
    assert a.latency_throughput_correlation == pytest.approx(1.0)


def test_zero_sent_and_single_run(spark):
    a = rn.run_analysis(runs_df(spark, [(0, 0, 1.0, 0, 0.0)])).collect()[0]
    assert a.processing_efficiency == 0.0 and a.throughput_cv == 0.0
    assert a.latency_throughput_correlation is None


def test_constant_side_gives_null_correlation(spark):
    a = rn.run_analysis(runs_df(spark, [(1, 1, 1.0, 0, 5.0), (1, 1, 2.0, 0, 5.0)])).collect()[0]
    assert a.latency_throughput_correlation is None


def test_high_latency_is_strict(spark):
    df = runs_df(spark, [(1, 1, 1.0, 0, 1.0), (1, 1, 1.0, 0, 1.0), (1, 1, 4.0, 1, 1.0)])
    assert [r.test_name for r in rn.high_latency_runs(df).collect()] == ["r2"]
    assert [r.test_name for r in rn.high_error_runs(df).collect()] == ["r2"]
    same = runs_df(spark, [(1, 1, 2.0, 0, 1.0), (1, 1, 2.0, 0, 1.0)])
    assert rn.high_latency_runs(same).count() == 0


def test_empty_run_gives_zeros(spark):
    runs = spark.createDataFrame([("empty", T0, T0 + dt.timedelta(hours=2))],
                                 "test_name string, start_time timestamp, end_time timestamp")
    out = spark.createDataFrame([], "publish_time timestamp, reject_reason string")
    lat = spark.createDataFrame([], "end_time timestamp, value double")
    r = rn.run_summary(runs, out, lat).collect()[0]
    assert (r.messages_sent, r.avg_latency, r.p50_latency, r.p99_latency, r.throughput) == (0, 0.0, 0.0, 0.0, 0.0)


def test_interval_join_half_open_and_multi_hour(spark):
    runs = spark.createDataFrame(
        [("a", T0, T0 + dt.timedelta(minutes=150)), ("b", T0 + dt.timedelta(minutes=150), T0 + dt.timedelta(hours=3))],
        "test_name string, start_time timestamp, end_time timestamp")
    facts = spark.createDataFrame(
        [(T0 + dt.timedelta(minutes=m),) for m in (0, 70, 149, 150, 179, 180)], "t timestamp")
    got = dict(rn.attach_runs(facts, runs, "t").groupBy("test_name").count().collect())
    assert got == {"a": 3, "b": 2}


def test_message_counts_inclusive_and_batch(spark):
    df = spark.createDataFrame(
        [(T0, T0, "b1"), (T0 + dt.timedelta(hours=1), None, "b1"), (T0 + dt.timedelta(hours=2), T0, "b2")],
        "timestamp timestamp, processing_timestamp timestamp, batch_id string")
    end = (T0 + dt.timedelta(hours=1)).isoformat(" ")
    r = rn.message_counts(df, T0.isoformat(" "), end).collect()[0]
    assert (r.sent, r.processed) == (2, 1)
    r = rn.message_counts(df, T0.isoformat(" "), end, batch_id="b2").collect()[0]
    assert (r.sent, r.processed) == (0, 0)


def test_unpivots(spark):
    df = runs_df(spark, [(3, 2, 1.5, 0, 1.0)])
    assert rn.latency_long(df).count() == 3
    rows = {r.kind: r["count"] for r in rn.efficiency_long(df).collect()}
    assert rows == {"Sent": 3, "Processed": 2}
    assert rn.throughput_errors(df).columns == ["test_name", "throughput", "errors"]
