import datetime as dt

from pyspark.sql import functions as F

from spindle.operators import alerts as al

T0 = dt.datetime(2024, 1, 1)
EPOCH = 1704067200  # T0 in UTC seconds


def fill_gaps(aligned, rules):
    """LT rules: every bucket between the rule's first and last bucket exists
    for every series; missing ones get 0."""
    lt = rules.where(F.col("comparison") == "LT").select("rule", "period_s")
    a = aligned.join(lt, "rule")
    span = a.groupBy("rule", "period_s").agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    series = a.select("rule", "series").distinct()
    grid = (series.join(span, "rule")
            .select("rule", "series", F.explode(F.sequence(
                "lo", "hi", F.make_dt_interval(secs=F.col("period_s")))).alias("bucket")))
    filled = (grid.join(a.select("rule", "series", "bucket", "value"), ["rule", "series", "bucket"], "left")
              .withColumn("value", F.coalesce("value", F.lit(0.0))))
    rest = aligned.join(lt, "rule", "left_anti")
    return rest.unionByName(filled)


def points(spark, mtype, rows):
    """rows: (series label, minute offset, value)."""
    df = spark.createDataFrame(
        [(mtype, s, T0 + dt.timedelta(minutes=m), float(v)) for s, m, v in rows],
        "metric_type string, s string, t timestamp, value double")
    return df.select("metric_type", F.lit("GAUGE").alias("metric_kind"), F.lit("DOUBLE").alias("value_type"),
                     "value", F.create_map(F.lit("s"), F.col("s")).alias("labels"),
                     F.create_map().cast("map<string,string>").alias("resource"),
                     F.col("t").alias("end_time"))


def runs(df):
    return sorted((r.series, r.start_time.minute + 60 * r.start_time.hour, r.buckets) for r in df.collect())


def test_sustained_gt_needs_whole_duration(spark):
    p = points(spark, "latency/x", [("a", m, 10) for m in range(0, 4)] + [("a", 10, 10)])
    r = al.rules_frame(spark, [al.rule("lat", "latency/x", "GT", 5, duration_s=240, period_s=60)])
    assert runs(al.evaluate(p, r)) == [('{"s":"a"}', 0, 4)]


def test_gap_ends_gt_run(spark):
    p = points(spark, "latency/x", [("a", m, 10) for m in (0, 1, 2, 4, 5, 6)])
    r = al.rules_frame(spark, [al.rule("lat", "latency/x", "GT", 5, duration_s=240, period_s=60)])
    assert runs(al.evaluate(p, r)) == []


def test_mean_alignment_per_series(spark):
    p = points(spark, "latency/x", [("a", 0, 10), ("a", 0, 0), ("b", 0, 10), ("b", 1, 10)])
    r = al.rules_frame(spark, [al.rule("lat", "latency/x", "GT", 6, duration_s=60, period_s=60)])
    assert runs(al.evaluate(p, r)) == [('{"s":"b"}', 0, 2)]


def test_lt_rule_counts_missing_buckets_as_zero(spark):
    p = points(spark, "counter/messages_processed", [("a", 0, 200), ("a", 5, 200)])
    r = al.rules_frame(spark, [al.rule("low", "counter/messages_processed", "LT", 100, duration_s=240,
                                       period_s=60, aligner="sum")])
    assert runs(al.evaluate(p, r)) == [('{"s":"a"}', 1, 4)]


def test_rules_with_different_periods(spark):
    p = points(spark, "latency/x", [("a", m, 10) for m in range(0, 10)])
    r = al.rules_frame(spark, [
        al.rule("fast", "latency/x", "GT", 5, duration_s=300, period_s=60),
        al.rule("slow", "latency/x", "GT", 5, duration_s=600, period_s=300),
    ])
    got = sorted((x.rule, x.buckets) for x in al.evaluate(p, r).collect())
    assert got == [("fast", 10), ("slow", 2)]


def test_config_rules_are_valid(spark):
    df = al.rules_frame(spark, al.CONFIG_RULES)
    assert df.where("wired").count() == 3


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series=st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 300)), max_size=25),
                       min_size=1, max_size=3),
       th=st.sampled_from([50.0, 150.0]), dur=st.sampled_from([60, 180]))
def test_gap_method_equals_grid_fill(spark, series, th, dur):
    rows = [(f"s{i}", m, v) for i, pts in enumerate(series) for m, v in pts]
    if not rows:
        return
    p = points(spark, "counter/messages_processed", rows)
    r = al.rules_frame(spark, [al.rule("low", "counter/messages_processed", "LT", th, duration_s=dur,
                                       period_s=60, aligner="sum")])
    aligned = al.aligned_by_rule(p, r)
    fast = al.breach_runs(aligned, r)
    grid = al.breach_runs(fill_gaps(aligned, r), r, fill_lt=False)
    key = lambda df: sorted((x.series, x.start_time, x.end_time, x.buckets) for x in df.collect())
    assert key(fast) == key(grid)


def test_rule_validation():
    import pytest
    with pytest.raises(ValueError):
        al.rule("x", "m", "GE", 1.0)
    with pytest.raises(ValueError):
        al.rule("x", "m", "GT", 1.0, period_s=0)
    with pytest.raises(ValueError):
        al.rule("x", "m", "GT", 1.0, aligner="median")


def test_rule_resource_type_filter(spark):
    p = points(spark, "latency/x", [("a", m, 10) for m in range(0, 5)])
    p = p.withColumn("resource", F.create_map(F.lit("type"), F.lit("generic_task")))
    for rtype, expected in (("generic_task", 1), ("gce_instance", 0), (None, 1)):
        r = al.rules_frame(spark, [al.rule("lat", "latency/x", "GT", 5, duration_s=120, period_s=60,
                                           resource_type=rtype)])
        assert al.evaluate(p, r).count() == expected, rtype


def test_outage_breaches_low_throughput(spark):
    """Processed in the first 10 of 120 minutes only; and a metric that never reports."""
    p = points(spark, "counter/done", [("a", m, 200) for m in range(10)])
    r = al.rules_frame(spark, [
        al.rule("low", "counter/done", "LT", 100, duration_s=300, period_s=60, aligner="sum"),
        al.rule("silent", "counter/none", "LT", 100, duration_s=300, period_s=60, aligner="sum")])
    got = {(x.rule, x.series, x.buckets) for x in al.evaluate(p, r, interval=(EPOCH, EPOCH + 120 * 60 - 1)).collect()}
    assert got == {("low", '{"s":"a"}', 110), ("silent", "{}", 120)}
    assert al.evaluate(p, r).count() == 0


def test_an_interval_leaves_the_edge_buckets_of_gt_rules(spark):
    """The evaluated interval is for what is filled; a breach before or after it still counts."""
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    aligned = spark.createDataFrame(
        [(rule, "s", t0 + dt.timedelta(seconds=60 * i), v) for i in range(6) for rule, v in (("high", 9.0), ("low", 9.0))],
        "rule string, series string, bucket timestamp, value double")
    rules = al.rules_frame(spark, [al.rule("high", "m", "GT", 5, duration_s=360, period_s=60),
                                   al.rule("low", "m", "LT", 5, duration_s=60, period_s=60)])
    first = int(t0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = al.breach_runs(aligned, rules, interval=(first + 60, first + 480)).collect()
    assert sorted((r.rule, r.start_time, r.buckets) for r in got) == [
        ("high", t0, 6), ("low", t0 + dt.timedelta(seconds=360), 3)]
