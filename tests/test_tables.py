import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException, ParseException

from spindle.schemas import LANDED_FLAT
from spindle.sources import results, tables
from spindle.sources.publish import publish, to_kafka_frame

T0 = dt.datetime(2024, 1, 1)


def test_create_table_idempotent_and_requires_schema(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_db LOCATION '{scratch}/db'")
    tables.create_database(spark, "t_db")
    tables.create_table(spark, "t_db.flat", LANDED_FLAT)
    tables.create_table(spark, "t_db.flat", LANDED_FLAT)
    assert tables.table_exists(spark, "t_db.flat")
    with pytest.raises(ValueError):
        tables.create_table(spark, "t_db.other", None)


def test_insert_rows_returns_errors(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_db2 LOCATION '{scratch}/db2'")
    rows = spark.createDataFrame(
        [("e1", T0, "{}", T0), (None, T0, "{}", T0), ("e3", T0, None, T0)],
        "event_id string, timestamp timestamp, data string, processing_timestamp timestamp")
    good, bad = tables.insert_rows(rows, LANDED_FLAT, "t_db2.flat")
    assert good.count() == 1
    assert sorted(r.error_field for r in bad.collect()) == ["data", "event_id"]
    assert spark.table("t_db2.flat").count() == 1


def test_insert_unknown_field_raises(spark):
    rows = spark.createDataFrame([("e1", 1)], "event_id string, nope int")
    with pytest.raises(ValueError):
        tables.insert_rows(rows, LANDED_FLAT)


def test_query_with_parameters_and_bad_sql(spark):
    df = tables.query(spark, "SELECT :a + 1 AS x", {"a": 41})
    assert df.collect()[0].x == 42
    with pytest.raises((ParseException, AnalysisException)):
        tables.query(spark, "SELEC oops").collect()


def test_results_round_trip(spark, scratch):
    from spindle.schemas import RUNS
    runs = spark.createDataFrame([("r", T0, T0 + dt.timedelta(hours=1), 3, 2, 1.0, 1.0, 2.0, 3.0, 1, 0.5)], RUNS)
    results.save_results(runs, f"{scratch}/runs")
    back = results.load_results(spark, f"{scratch}/runs").collect()[0]
    assert back.start_time == T0 and back.messages_sent == 3 and back.throughput == 0.5


def test_publish_round_trip_and_kafka_frame(spark):
    df = spark.createDataFrame([("e1", 5)], "id string, n int")
    m = publish(df, F.struct("id", "n"), F.lit("m1"), F.lit(T0),
                ordering_key=F.lit("k"), attributes=F.create_map(F.lit("a"), F.lit("b")))
    r = m.select(F.col("value").cast("string").alias("v"), "ordering_key", "attributes").collect()[0]
    assert r.v == '{"id":"e1","n":5}' and r.ordering_key == "k" and r.attributes == {"a": "b"}
    k = to_kafka_frame(m).collect()[0]
    assert k.key == bytearray(b"k") and k.headers[0].key == "a"


def test_landed_table_prunes_and_pushes_down(spark, scratch):
    from spindle.plans import derived
    from tests.conftest import SF_SMALL

    tables.write_landed(derived.landed(spark, SF_SMALL), f"{scratch}/landed", mode="overwrite")
    t = spark.read.parquet(f"{scratch}/landed")
    q = t.where((F.col("date") == "2024-01-05") & (F.col("event_id") == "evt-150")).select("event_id", "timestamp")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "EqualTo(event_id,evt-150)" in plan
    assert "ReadSchema: struct<event_id:string,timestamp:timestamp>" in plan
    assert q.count() <= 1


def test_write_messages_bounds_batch_size(spark, scratch):
    import os

    from spindle.sources.publish import write_messages
    df = spark.createDataFrame([(str(i),) for i in range(10)], "id string").coalesce(1)
    m = publish(df, F.struct("id"), F.col("id"), F.lit(T0))
    write_messages(m, f"{scratch}/topic", max_records_per_file=3)
    files = [f for f in os.listdir(f"{scratch}/topic") if f.endswith(".parquet")]
    assert len(files) == 4 and spark.read.parquet(f"{scratch}/topic").count() == 10


def test_load_results_json_array(spark, scratch):
    """Run results written as one JSON array with ISO text timestamps."""
    import json
    import os

    recs = [{"test_name": "constant_load_10mps", "start_time": "2024-01-01T00:00:00",
             "end_time": "2024-01-01T00:01:00Z", "messages_sent": 600, "messages_processed": 598,
             "avg_latency": 0.2, "p50_latency": 0.1, "p95_latency": 0.5, "p99_latency": 0.9,
             "errors": 2, "throughput": 9.97},
            {"test_name": "bad_time", "start_time": "not a time", "end_time": None, "messages_sent": 1,
             "messages_processed": 1, "avg_latency": 0.0, "p50_latency": 0.0, "p95_latency": 0.0,
             "p99_latency": 0.0, "errors": 0, "throughput": 0.0}]
    os.makedirs(f"{scratch}/arr")
    with open(f"{scratch}/arr/results.json", "w") as fh:
        json.dump(recs, fh, indent=2)
    rows = {r.test_name: r for r in results.load_results(spark, f"{scratch}/arr", multiline=True).collect()}
    assert rows["constant_load_10mps"].end_time == T0 + dt.timedelta(minutes=1)
    assert rows["constant_load_10mps"].messages_processed == 598
    assert rows["bad_time"].start_time is None


def test_append_stream_to_table(spark, scratch):
    from spindle.streaming import ingest

    src = f"{scratch}/rows"
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(src)
    stream = spark.readStream.schema("k string, v int").parquet(src)
    q = ingest.append_stream(stream, "appended_rows", f"{scratch}/ck_append")
    q.processAllAvailable()
    q.stop()
    assert spark.table("appended_rows").count() == 2


def test_catalog_join_marks_undeclared_metrics(spark):
    from spindle.operators import metrics as mx

    pts = spark.createDataFrame([("counter/messages_received",), ("counter/errors/json_syntax",)],
                                "metric_type string")
    got = {r.name: r.declared_kind for r in mx.with_catalog(pts, mx.catalog_frame(spark)).collect()}
    assert got == {"messages_received": "counter", "errors/json_syntax": None}


def test_metric_points_store_prunes_by_date(spark, scratch):
    from spindle.operators import metrics as mx
    from spindle.plans import derived
    from tests.conftest import SF_SMALL

    tables.write_points(derived.metrics(spark, SF_SMALL), f"{scratch}/points", mode="overwrite")
    pts = spark.read.parquet(f"{scratch}/points")
    s = mx.scan(pts, derived.LATENCY_METRIC, "2024-01-10 00:00:00", "2024-01-10 23:59:59").where(
        F.col("date") == "2024-01-10")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(metric_type" in plan
    assert s.count() == derived.metrics(spark, SF_SMALL).where(
        F.to_date("end_time") == "2024-01-10").count()


def test_save_analysis(spark, scratch):
    from spindle.schemas import RUNS
    rows = [(f"r{i}", T0, T0, 10, 9 + (i == 2), 1.0 + 3 * (i == 2), 0.0, 0.0, 0.0, int(i == 1), 1.0 + i)
            for i in range(3)]
    results.save_analysis(spark.createDataFrame(rows, RUNS), f"{scratch}/analysis")
    s = spark.read.json(f"{scratch}/analysis/summary").collect()[0]
    assert s.total_tests == 3 and s.total_messages_sent == 30 and s.total_errors == 1
    assert [r.test_name for r in spark.read.json(f"{scratch}/analysis/high_error_runs").collect()] == ["r1"]
    assert [r.test_name for r in spark.read.json(f"{scratch}/analysis/high_latency_runs").collect()] == ["r2"]


def test_files_per_date_bounds_file_count(spark, scratch):
    import glob

    from spindle.plans import derived
    from tests.conftest import SF_SMALL

    landed = derived.landed(spark, SF_SMALL)
    tables.write_landed(landed, f"{scratch}/l2", mode="overwrite", files_per_date=2)
    days = glob.glob(f"{scratch}/l2/date=*")
    files = glob.glob(f"{scratch}/l2/date=*/*.parquet")
    assert len(files) <= 2 * len(days)
    assert spark.read.parquet(f"{scratch}/l2").count() == landed.count()


def test_required_fields_live_with_the_table(spark, scratch):
    from pyspark.sql import types as T

    from spindle.schemas import LANDED

    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_req LOCATION '{scratch}/req'")
    tables.create_table(spark, "t_req.flat", LANDED_FLAT)
    assert tables.required_of(spark, "t_req.flat") == ["event_id", "timestamp", "data", "processing_timestamp"]
    assert tables.required_paths(LANDED)[-3:] == ["metadata", "metadata.source", "metadata.version"]
    shape = "event_id string, timestamp timestamp, data string, processing_timestamp timestamp"
    good = spark.createDataFrame([("e1", T0, "{}", T0)], shape)
    bad = spark.createDataFrame([("e2", T0, "{}", T0), ("e3", T0, None, T0)], shape)
    tables.append(good, "t_req.flat")
    with pytest.raises(Exception, match="t_req.flat: data"):
        tables.append(bad, "t_req.flat")
    with pytest.raises(Exception, match="processing_timestamp"):  # a column that the rows lack
        tables.append(good.drop("processing_timestamp"), "t_req.flat")
    assert spark.table("t_req.flat").count() == 1
    # insert_rows asks the table, not the schema that it is given
    free = T.StructType([T.StructField(f.name, f.dataType, True) for f in LANDED_FLAT.fields])
    kept, errors = tables.insert_rows(bad, free, "t_req.flat")
    assert [(r.event_id, r.error_field) for r in errors.collect()] == [("e3", "data")]
    assert sorted(r.event_id for r in spark.table("t_req.flat").collect()) == ["e1", "e2"]
    tables.require(spark, "t_req.flat", ["event_id"])
    tables.append(spark.createDataFrame([("e4", T0, None, T0)], shape), "t_req.flat")
    with pytest.raises(Exception, match="event_id"):
        tables.append(spark.createDataFrame([(None, T0, None, T0)], shape), "t_req.flat")


def test_required_fields_inside_structs_and_variants(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_req2 LOCATION '{scratch}/req2'")
    from spindle.schemas import LANDED

    tables.create_table(spark, "t_req2.landed", LANDED)
    rows = spark.sql("""SELECT id AS event_id, TIMESTAMP'2024-01-01' AS timestamp, TIMESTAMP'2024-01-01' AS processing_timestamp,
        parse_json(d) AS data, named_struct('source', s, 'version', '1') AS metadata, CAST(NULL AS MAP<STRING, STRING>) AS attributes
        FROM VALUES ('a', '{}', 's'), ('b', 'null', 's'), ('c', '{}', CAST(NULL AS STRING)) AS t(id, d, s)""")
    for event_id, field in (("b", "data"), ("c", "metadata.source")):
        with pytest.raises(Exception, match=f"landed: {field}"):
            tables.append(rows.where(F.col("event_id") == event_id), "t_req2.landed")
    tables.append(rows.where("event_id = 'a'"), "t_req2.landed")
    assert spark.table("t_req2.landed").count() == 1


def test_append_stream_keeps_required_fields(spark, scratch):
    from spindle.streaming.ingest import append_stream

    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_req3 LOCATION '{scratch}/req3'")
    tables.create_table(spark, "t_req3.flat", LANDED_FLAT)
    shape = "event_id string, timestamp timestamp, data string, processing_timestamp timestamp"
    src = f"{scratch}/src"
    spark.createDataFrame([("e1", T0, "{}", T0)], shape).write.parquet(src)
    stream = spark.readStream.schema(shape).parquet(src)
    q = append_stream(stream, "t_req3.flat", f"{scratch}/ck")
    try:
        q.processAllAvailable()
        assert spark.table("t_req3.flat").count() == 1
        spark.createDataFrame([("e2", T0, None, T0)], shape).write.mode("append").parquet(src)
        with pytest.raises(Exception, match="required field is null"):
            q.processAllAvailable()
    finally:
        q.stop()
    spark.catalog.refreshTable("t_req3.flat")
    assert spark.table("t_req3.flat").count() == 1
