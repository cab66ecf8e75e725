"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from spindle.plans.catalog import REGISTRY
from tests.conftest import SF_SMALL

NAMES = sorted(REGISTRY)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v  # exact: both sides round identically
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events",):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(oracle_sql()) and set(oracle_sql()) <= set(queries())


# Row-level queries over messages: map-only, no shuffle on any key.
MAP_ONLY = {"publish_envelope", "parse_json", "enrich_processing_ts", "validate_required",
            "validate_timestamp", "ingest_valid", "conform_schema", "conform_flat", "insert_errors",
            "nested_lookup", "point_lookup", "end_to_end_latency", "metrics_points", "metric_scan",
            "reject_log_rows"}


# Grouping queries: the aggregate must be split so rows combine map-side before
# the shuffle (a key holding a third of all rows costs one row per task).
PRE_AGGREGATED = {"reject_reasons", "tumbling_counts", "duplicate_ids", "batch_stats", "outcome_counts",
                  "errors_by_stage", "aligned_mean", "dashboard_rollup", "metric_stats", "message_counts",
                  "metric_percentiles", "metric_catalog_usage", "run_summary"}


# Queries that run a user's Python function, as an Arrow table function.
USER_CODE = {"hook_rows", "errors_all_stages"}


def _check_plan(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "CartesianProduct" not in plan, name
    if name not in USER_CODE:
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, (name, node)
    if not name.startswith("alerts_"):
        assert "BroadcastNestedLoopJoin" not in plan, name
    if name in MAP_ONLY:
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan, name
    if name in PRE_AGGREGATED:
        assert "functions=[partial_" in plan, name


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    _check_plan(name, df)
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), ocols)


def test_alert_points_meet_no_rule_before_alignment(spark):
    """One parse, points combined map-side, and no nested loop over raw points."""
    from spindle.operators import alerts as al
    from spindle.operators import metrics as mx
    from spindle.plans import derived

    points = mx.outcome_points(derived.outcomes(spark, SF_SMALL), derived.DEFAULT_LABELS, error_rate=True)
    points = points.unionByName(derived.metrics(spark, SF_SMALL))
    rules = al.rules_frame(spark, [r for r in al.CONFIG_RULES if r[7]])
    plan = al.aligned_by_rule(points, rules)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "partial_sum" in plan
    assert plan.count("Scan parquet") == 2  # messages and latency points, each once
    assert plan.index("BroadcastHashJoin") < plan.rindex("partial_sum")  # the alignment stands below the join


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert os.path.isdir(SF_SMALL)


def test_column_pruning_reaches_the_scan(spark):
    """Only the columns a query uses are read, also after the small-input spread."""
    df = queries()["metric_percentiles"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan
    df = queries()["metric_scan"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan


def test_metric_stats_covers_every_event_type_of_the_data(spark, scratch):
    from spindle.plans import catalog

    # Ids of messages that are processed, and one that fails and so has no latency.
    rows = [(28, "chat", 2.0, "2024-01-10 01:00:00"), (29, "chat", 4.0, "2024-01-11 01:00:00"),
            (30, None, 5.0, "2024-01-10 02:00:00"), (31, "late", 6.0, "2024-02-01 00:00:00"),
            (21, "chat", 9.0, "2024-01-10 01:00:00")]
    (spark.createDataFrame(rows, "event_id long, event_type string, value double, ts string")
     .selectExpr("event_id", "event_id as user_id", "event_type", "value", "cast(ts as timestamp_ntz) as ts", "'{}' as props")
     .write.parquet(f"{scratch}/events.parquet"))
    got = {r.event_type: (r.n, r["mean"]) for r in catalog.metric_stats(spark, scratch).collect()}
    assert (got["chat"], got[None], got["late"], got["refund"]) == ((2, 3.0), (1, 5.0), (0, 0.0), (0, 0.0))
