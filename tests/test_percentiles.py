import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spindle.operators.percentiles import approx_percentiles, exact_percentiles

PS = (0.0, 0.5, 0.95, 0.99)


def brute(values, p):
    s = sorted(values)
    return s[int(len(s) * p)]


values_st = st.lists(
    st.one_of(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
              st.sampled_from([0.0, 1.0, 1.0005, 999.9999, 1000.0, -2.5, 1e-9, 5e-324, -1e-310,
                               1.7976931348623157e308, float("inf"), float("-inf")])),
    min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups=st.lists(values_st, min_size=1, max_size=3))
def test_exact_matches_floor_index(spark, groups):
    rows = [(g, float(v)) for g, vals in enumerate(groups) for v in vals]
    df = spark.createDataFrame(rows, "g int, value double")
    got = {(r.g, r.p): r.value for r in exact_percentiles(df, ["g"], "value", PS).collect()}
    for g, vals in enumerate(groups):
        for p in PS:
            assert got[(g, p)] == brute(vals, p)


def test_rule_differs_from_interpolation(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 4)], "g int, value double")
    got = {r.p: r.value for r in exact_percentiles(df, ["g"], "value", [0.5]).collect()}
    assert got[0.5] == 3.0


def test_hot_group_many_values(spark):
    rnd = random.Random(7)
    vals = [round(rnd.lognormvariate(3, 1), 2) for _ in range(20000)]
    df = spark.createDataFrame([(0, v) for v in vals] + [(1, 5.0)], "g int, value double")
    got = {(r.g, r.p): r.value for r in exact_percentiles(df, ["g"], "value", PS).collect()}
    for p in PS:
        assert got[(0, p)] == brute(vals, p)
        assert got[(1, p)] == 5.0


def test_approx_close(spark):
    vals = [float(i) for i in range(1000)]
    df = spark.createDataFrame([(0, v) for v in vals], "g int, value double")
    got = {r.p: r.value for r in approx_percentiles(df, ["g"], "value", [0.5, 0.99]).collect()}
    assert abs(got[0.5] - 500) <= 2 and abs(got[0.99] - 990) <= 2


def test_bucket_is_monotone_on_edge_values(spark):
    from pyspark.sql import functions as F

    from spindle.operators.percentiles import coarse_bucket
    vals = sorted([5e-324, 1e-310, 1e-300, 0.0, 1.0, 9.999, 10.0, 10.001, 1e308, -1e308, -1.0,
                   -5e-324, float("inf"), float("-inf")]) + [float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    keys = [r.b for r in df.select("i", coarse_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert keys == sorted(keys)


def test_values_packed_in_one_coarse_bucket(spark):
    """All values within a relative 1e-3: finer spans still find the exact rank."""
    vals = [1.0 + i * 1e-9 for i in range(3000)] + [1.0004] * 50 + [-1.0 - i * 1e-9 for i in range(500)]
    df = spark.createDataFrame([(0, v) for v in vals], "g int, value double")
    got = {r.p: r.value for r in exact_percentiles(df, ["g"], "value", PS).collect()}
    for p in PS:
        assert got[p] == brute(vals, p)
    got = {r.p: r.value for r in exact_percentiles(df, ["g"], "value", PS, sliver_rows=5).collect()}
    for p in PS:
        assert got[p] == brute(vals, p)


def test_no_values_leave_no_rows(spark):
    df = spark.createDataFrame([(0, None)], "g int, value double")
    assert exact_percentiles(df, ["g"], "value", PS).collect() == []
