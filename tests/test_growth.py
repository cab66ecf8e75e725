"""Steps whose tasks keep their size as the tables grow."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.operators import alerts as al
from spindle.operators import hooks
from spindle.plans import derived
from spindle.plans.catalog import REGISTRY
from spindle.sources import batches, store
from spindle.sources.files import read_parquet
from spindle.streaming import alerting, ordered
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_more_rows_are_read_by_more_tasks(spark, scratch):
    spark.range(1_000).coalesce(1).write.parquet(f"{scratch}/t")
    assert read_parquet(spark, f"{scratch}/t").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    spread = read_parquet(spark, f"{scratch}/t", task_rows=50)
    held = [n for n, in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(held) == 20 and max(held) <= 60 and sum(held) == 1_000


def test_hook_is_called_on_batches_and_sends_many_rows_in_pieces(spark):
    out = T.StructType([T.StructField("i", T.IntegerType())])
    df = spark.range(3).select("id", F.parse_json(F.lit('{"a":1}')).alias("data"))
    many = hooks.expand(df, lambda n: ((i,) for i in range(n * 12_000)), ["id"], out)
    assert "MapInArrow" in _plan(many)
    assert sorted(tuple(r) for r in many.groupBy("id").agg(F.count("i"), F.max("i")).collect()) == [(1, 12_000, 11_999), (2, 24_000, 23_999)]


def test_errors_of_all_stages_parse_once_and_call_the_hook_once(spark):
    plan = _plan(REGISTRY["errors_all_stages"](spark, SF_SMALL))
    assert "events.parquet" not in plan and "MapInArrow" not in plan and "PythonUDTF" not in plan


def test_points_of_one_metric_type_do_not_meet_in_one_task(spark, scratch):
    derived.metrics(spark, SF_SMALL).write.parquet(f"{scratch}/points")
    rules = al.rules_frame(spark, [al.rule("r", derived.LATENCY_METRIC, "GT", 1.0)])
    with_size = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(with_size)
    spark.conf.set(with_size, "-1")  # as on a stream, where the rules' size is not known
    try:
        plan = _plan(alerting.closed_buckets(spark.read.parquet(f"{scratch}/points"), rules, "300 seconds"))
    finally:
        spark.conf.set(with_size, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_publish_batches_are_cut_from_small_parts(spark):
    assert batches.PART_ROWS <= 100_000
    rows = spark.range(250_000).select(
        F.lit("k").alias("key"), F.col("id").alias("at_us"), F.col("id").cast("string").alias("id"),
        F.lit(1).cast("long").alias("size"), F.col("id").alias("row"))
    got = batches.cut(rows, batches.Limits(max_messages=1_000)).groupBy("batch").count().collect()
    assert sorted(tuple(r) for r in got) == [(b, 1_000) for b in range(250)]


def test_held_messages_are_stored_in_chunks():
    messages = [(i, f"m{i}" if i % 3 else None, b"v", [("k", "v")] if i % 2 else None) for i in range(12_000)]
    chunks = ordered.pack(messages)
    assert len(chunks) == 3 and [m for c, in chunks for m in ordered.unpack(c)] == messages


def test_store_keeps_no_message_text(spark):
    kept = store.read(spark, derived.store(spark, SF_SMALL), "outcomes")
    assert set(kept.columns) == {"event_id", "timestamp", "processing_timestamp", "data", "metadata", "attributes", "reject_reason"}
