"""Lookups open little of the store, and counts by sums equal counts by rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spindle.plans import derived
from spindle.plans.catalog import REGISTRY
from spindle.sources import store
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _scanned(df):
    """(rows out of the scan, plan text) after running ``df``."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value(), plan.toString()


def test_lookups_read_a_small_part(spark, scratch):
    rows = spark.range(60_000).select(
        F.concat(F.lit("evt-"), F.md5(F.col("id").cast("string"))).alias("event_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("timestamp"),
        F.repeat(F.md5(F.col("id").cast("string")), 8).alias("data"))
    store.write_rows(rows, scratch, files=12, row_group=64 << 10)
    some = rows.where("id = 41234").first().event_id
    read, plan = _scanned(store.lookup(spark, scratch, some))
    assert read <= 2_000 and "EqualTo(event_id" in plan and store.lookup(spark, scratch, some).count() == 1
    read, _ = _scanned(store.lookup(spark, scratch, some[:-1] + "-"))  # between two stored ids: the Bloom filter knows
    assert read == 0
    prefixed = store.with_prefix(spark, scratch, some[:7])
    read, plan = _scanned(prefixed)
    assert read < 10_000 and "StringStartsWith(event_id" in plan
    assert prefixed.count() == rows.where(F.col("event_id").startswith(some[:7])).count() > 1


@pytest.fixture(scope="module")
def counted(spark, tmp_path_factory):
    rnd = random.Random(3)
    rows = [(f"e{i}", T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(3 * 86_400), 60 * rnd.randrange(20), 86_400])),
             None if rnd.random() < 0.3 else T0, "b") for i in range(3000)] + [("none", None, T0, "b")]
    df = spark.createDataFrame(rows, "event_id string, timestamp timestamp, processing_timestamp timestamp, batch_id string")
    path = str(tmp_path_factory.mktemp("store"))
    store.write_counts(df, path)
    return path, rows


@pytest.mark.parametrize("seed", range(6))
def test_counts_between_equal_a_scan(spark, counted, seed):
    path, rows = counted
    rnd = random.Random(seed)
    lo = T0 + dt.timedelta(seconds=rnd.choice([-5000, 0, 60, 86_400, rnd.randrange(250_000)]))
    hi = rnd.choice([None, lo, lo + dt.timedelta(seconds=rnd.choice([1, 59, 60, 86_400, 10**6]))])
    own = [r for r in rows if r[1] is not None and lo <= r[1] and (hi is None or r[1] <= hi)]
    got = store.count_between(spark, path, str(lo), None if hi is None else str(hi)).collect()
    assert [tuple(r) for r in got] == [(len(own), sum(r[2] is not None for r in own))]


def test_an_interval_without_rows(spark, scratch):
    empty = spark.createDataFrame([], "event_id string, timestamp timestamp, processing_timestamp timestamp, batch_id string")
    row = empty.unionByName(spark.createDataFrame([("a", T0, None, "b")], empty.schema))
    store.write_counts(row, scratch)
    assert tuple(store.count_between(spark, scratch, "2023-01-01 00:00:00", "2023-01-02 00:00:00").first()) == (0, 0)
    assert tuple(store.count_between(spark, scratch, "2024-01-01 00:00:00").first()) == (1, 0)


@pytest.mark.parametrize("name", ["message_counts", "message_counts_batch", "message_counts_landed", "recent_count",
                                  "point_lookup", "prefix_count", "sample_rows"])
def test_stored_queries_parse_no_json(spark, name):
    derived.store(spark, SF_SMALL)
    plan = REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "parse_json" not in plan and "Scan parquet" in plan.replace("FileScan", "Scan") and "NestedLoop" not in plan
    if name in ("point_lookup", "prefix_count"):
        assert "event_id" in plan.split("PushedFilters")[1][:200]
