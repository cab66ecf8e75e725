import datetime as dt
import json
import os

from spindle.operators import envelope
from spindle.schemas import MESSAGE
from spindle.streaming import ingest
from tests.conftest import SF_SMALL
from tests.helpers import messages_df


def _write_messages(spark, path):
    from spindle.plans import derived
    m = derived.messages(spark, SF_SMALL)
    m.repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.schema(MESSAGE).parquet(path)


def test_stream_equals_batch_and_restart(spark, scratch):
    src = f"{scratch}/in"
    batch_msgs = _write_messages(spark, src)
    expected = envelope.outcomes(batch_msgs)
    n_landed = envelope.landed(expected).count()
    n_rej = envelope.rejects(expected).count()
    stream = ingest.read_messages(spark, src, max_files_per_trigger=1)
    ck = f"{scratch}/ckpt"
    q = ingest.start_ingest(stream, f"{scratch}/landed", f"{scratch}/rejects", checkpoint=ck,
                            available_now=True)
    q.awaitTermination(300)
    progress = [json.loads(p.json) for p in q.recentProgress]
    observed = [p["observedMetrics"]["ingest"] for p in progress if p.get("observedMetrics")]
    assert sum(o["received"] for o in observed) == batch_msgs.count()
    assert sum(o["rejected"] for o in observed) == n_rej - envelope.outcomes(batch_msgs).where(
        "reject_reason = 'required_null'").count()
    assert spark.read.parquet(f"{scratch}/landed").count() == n_landed
    assert spark.read.parquet(f"{scratch}/rejects").count() == n_rej
    # restart on the same checkpoint with no new input: nothing is written twice
    q = ingest.start_ingest(ingest.read_messages(spark, src), f"{scratch}/landed", f"{scratch}/rejects",
                            checkpoint=ck, available_now=True)
    q.awaitTermination(300)
    assert spark.read.parquet(f"{scratch}/landed").count() == n_landed
    landed = spark.read.parquet(f"{scratch}/landed").drop("batch_id")
    assert landed.select("event_id").exceptAll(envelope.landed(expected).select("event_id")).count() == 0


def _msg(eid, seconds):
    t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)
    return json.dumps({"event_id": eid, "timestamp": t.isoformat(), "data": {"event_type": "x"},
                       "metadata": {"source": "s", "version": "1"}})


def test_late_rows_dropped_by_previous_watermark(spark, scratch):
    """Watermark = max event time of earlier micro-batches - 300 s.

    Batches: max 70 s; max 600 s; a filler (600 s); then rows at 20 s and
    310 s. The 20 s row is behind the watermark (300 s) and dropped; the
    310 s row is kept.
    """
    src = f"{scratch}/late"
    os.makedirs(src)
    batches = [[_msg("a", 70)], [_msg("b", 600)], [_msg("c", 600)], [_msg("d", 20), _msg("e", 310)]]
    stream = ingest.read_messages(spark, src)
    counts = ingest.windowed_counts(envelope.landed(envelope.outcomes(stream)))
    q = (counts.writeStream.outputMode("append").format("memory").queryName("late_counts")
         .option("checkpointLocation", f"{scratch}/late_ckpt").trigger(processingTime="1 second").start())
    try:
        for i, b in enumerate(batches):
            messages_df(spark, b).coalesce(1).write.parquet(f"{scratch}/stage{i}")
            part = [f for f in os.listdir(f"{scratch}/stage{i}") if f.endswith(".parquet")][0]
            os.rename(f"{scratch}/stage{i}/{part}", f"{src}/b{i}.parquet")
            q.processAllAvailable()
        dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                      for p in (json.loads(x.json) for x in q.recentProgress) if p.get("stateOperators"))
    finally:
        q.stop()
    assert dropped == 1
    starts = {(r.window_start.hour * 60 + r.window_start.minute) for r in spark.table("late_counts").collect()}
    # Only [60 s, 120 s) has closed (watermark 300 s); [300 s, 360 s) holds the kept row, still open.
    assert starts == {1}


def test_dedupe_within_watermark(spark, scratch):
    src = f"{scratch}/dups"
    messages_df(spark, [_msg("a", 10), _msg("a", 10), _msg("b", 20)]).write.parquet(src)
    landed = envelope.landed(envelope.outcomes(ingest.read_messages(spark, src)))
    q = (ingest.dedupe_within_watermark(landed).writeStream.format("memory").queryName("dedup")
         .option("checkpointLocation", f"{scratch}/dd_ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("dedup").count() == 2
    assert os.path.isdir(f"{scratch}/dd_ckpt")


def test_raw_copy_and_observed_counts(spark, scratch):
    src = f"{scratch}/raw_in"
    messages_df(spark, [_msg("a", 10), "bad"]).write.parquet(src)
    q = ingest.start_ingest(ingest.read_messages(spark, src), f"{scratch}/l", f"{scratch}/r",
                            checkpoint=f"{scratch}/raw_ckpt", raw_path=f"{scratch}/raw",
                            metrics_path=f"{scratch}/m", available_now=True)
    q.awaitTermination(300)
    m = {(r.metric_type, r.value) for r in spark.read.parquet(f"{scratch}/m").collect()
         if r.metric_type != "latency/batch_processing_time"}
    assert m == {("counter/messages_received", 2.0), ("counter/messages_processed", 1.0),
                 ("counter/messages_failed", 1.0), ("counter/errors/json_syntax", 1.0),
                     ("counter/parsing_errors", 1.0),
                 ("batch_size/batch_size", 2.0)}
    raw = spark.read.parquet(f"{scratch}/raw")
    assert raw.count() == 2 and "date" in raw.columns
    assert spark.read.parquet(f"{scratch}/r").collect()[0].reject_reason == "json_syntax"


def test_periodic_metric_export(spark, scratch):
    from spindle.operators import metrics as mx

    src = f"{scratch}/pts_in"
    messages_df(spark, [_msg("a", 10), _msg("b", 20), "bad"]).write.parquet(src)
    out = envelope.outcomes(ingest.read_messages(spark, src))
    points = mx.outcome_points(out)
    q = ingest.export_rollup(points, f"{scratch}/export", f"{scratch}/export_ckpt",
                             period="1 second", lateness="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.metric_type, r["sum"]) for r in spark.read.parquet(f"{scratch}/export").collect()}
    # publish times are 0, 1 and 2 s past T0: one message per 1 s window; the
    # last window stays open until the watermark passes it.
    assert ("counter/messages_received", 1.0) in got
    assert ("counter/messages_processed", 1.0) in got


def test_ordered_by_key(spark):
    from spindle.sources.publish import ordered_by_key

    rows = [("k1", i) for i in (3, 1, 2)] + [("k2", i) for i in (9, 8)]
    df = spark.createDataFrame(
        [(bytearray(b"x"), {}, k, f"m{t}", dt.datetime(2024, 1, 1, 0, 0, t)) for k, t in rows],
        MESSAGE)
    parts = ordered_by_key(df, 2).rdd.glom().collect()
    for part in parts:
        keys = [r.ordering_key for r in part]
        for k in set(keys):
            times = [r.publish_time for r in part if r.ordering_key == k]
            assert times == sorted(times)
    # a key never spans partitions
    seen = {}
    for i, part in enumerate(parts):
        for r in part:
            assert seen.setdefault(r.ordering_key, i) == i


def test_publish_then_ingest_end_to_end(spark, scratch):
    """Volume case: 100 rows published as messages by a stream, all 100 land."""
    from pyspark.sql import functions as F

    from spindle.sources.publish import publish, start_publish

    src = f"{scratch}/rows"
    spark.range(100).select(
        F.concat(F.lit("perf-test-"), F.col("id").cast("string")).alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("ts"),
        F.col("id")).write.parquet(src)
    rows = spark.readStream.schema("event_id string, ts timestamp, id long").parquet(src)
    msgs = publish(rows, F.struct(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.struct(F.col("id").alias("test_value")).alias("data"),
        F.struct(F.lit("perf").alias("source"), F.lit("1.0").alias("version")).alias("metadata")),
        message_id=F.col("event_id"), publish_time=F.col("ts"),
        attributes=F.create_map(F.lit("batch_id"), F.lit("b1")))
    p = start_publish(msgs, f"{scratch}/topic", f"{scratch}/pub_ck", available_now=True)
    p.awaitTermination(300)
    q = ingest.start_ingest(ingest.read_messages(spark, f"{scratch}/topic"), f"{scratch}/landed",
                            f"{scratch}/rejects", checkpoint=f"{scratch}/ing_ck", available_now=True)
    q.awaitTermination(300)
    landed = spark.read.parquet(f"{scratch}/landed")
    assert landed.where(F.col("event_id").like("perf-test-%")).count() == 100
    row = landed.where(F.col("event_id") == "perf-test-7").select(
        F.try_variant_get("data", "$.test_value", "int").alias("v")).collect()[0]
    assert row.v == 7


def test_fixed_window_keeps_duplicates(spark):
    """Two identical messages in one 60 s window: two rows out, counted twice."""
    msg = _msg("dup-1", 10)
    landed = envelope.landed(envelope.outcomes(messages_df(spark, [msg, msg])))
    rows = ingest.windowed_counts(landed).collect()
    assert [(r.event_type, r.n) for r in rows] == [("x", 2)]
    assert rows[0].window_end - rows[0].window_start == dt.timedelta(seconds=60)


def test_kafka_rows_map_to_messages(spark):
    """The Kafka source's row shape maps onto the message schema (no broker needed)."""
    rows = [(bytearray(b"user-1"), bytearray(_msg("k1", 5).encode()), "events", 3, 41,
             dt.datetime(2024, 1, 1, 0, 0, 5), [("batch_id", bytearray(b"b7"))]),
            (None, bytearray(b"oops"), "events", 0, 7, dt.datetime(2024, 1, 1, 0, 0, 6), None)]
    raw = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, "
                                      "timestamp timestamp, headers array<struct<key:string,value:binary>>")
    msgs = ingest.from_kafka_rows(raw)
    assert msgs.schema.fieldNames() == MESSAGE.fieldNames()
    got = {r.message_id: r for r in msgs.collect()}
    assert got["events-3-41"].ordering_key == "user-1" and got["events-3-41"].attributes == {"batch_id": "b7"}
    assert got["events-0-7"].attributes == {}
    out = {r.message_id: r.reject_reason for r in envelope.outcomes(msgs).collect()}
    assert out == {"events-3-41": None, "events-0-7": "json_syntax"}


def test_dedupe_copies_batch_and_stream(spark, scratch):
    """Copies (same id and time) collapse to the earliest delivery, in batch and in a stream."""
    from pyspark.sql import functions as F

    msgs = [_msg("a", 10)] * 5 + [_msg("b", 20)] * 2 + [_msg("c", 700)]
    landed = envelope.landed(envelope.outcomes(messages_df(spark, msgs)))
    got = {r.event_id: r.processing_timestamp for r in ingest.dedupe_copies(landed).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert got["a"] == landed.where(F.col("event_id") == "a").agg(F.min("processing_timestamp")).first()[0]

    src = f"{scratch}/copies"
    messages_df(spark, msgs).write.parquet(src)
    stream = envelope.landed(envelope.outcomes(ingest.read_messages(spark, src)))
    q = (ingest.dedupe_copies(stream, lateness="0 seconds").writeStream.outputMode("append")
         .format("memory").queryName("copies").option("checkpointLocation", f"{scratch}/copies_ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    # the watermark reaches 700 s ("c"); state is evicted at event time <= watermark,
    # so every group is emitted once, after its copies are merged
    rows = spark.table("copies").collect()
    assert sorted(r.event_id for r in rows) == ["a", "b", "c"]
