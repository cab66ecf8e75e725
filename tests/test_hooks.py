"""A user's generator on a batch and on a stream, and rows that a stored table does not take."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.operators import hooks
from spindle.operators.metrics import errors_by_stage
from spindle.sources import tables

OUT = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("word", T.StringType())])
ROWS = [(1, "a b c"), (2, ""), (3, "boom"), (4, "x"), (5, None), (6, "wide"), (7, "typed"), (1, "a b c")]


def words(text):
    if text == "wide":
        yield 1, "a", "b"
    if text == "typed":
        yield "no number", "a"
    for i, w in enumerate((text or "").split()):
        if text == "boom":
            yield 9, "lost"  # what came before an error does not count
            raise KeyError(text)
        yield i, w


def _told(df):
    return sorted((r.id, r.text or "", -1 if r.i is None else r.i, r.word or "", (r.hook_error or "").split(":")[0])
                  for r in df.collect())


WANT = sorted([(1, "a b c", i, w, "") for i, w in enumerate("abc")] * 2 + [(4, "x", 0, "x", ""),
              (3, "boom", -1, "", "KeyError"), (6, "wide", -1, "", "ValueError"), (7, "typed", -1, "", "ArrowInvalid")])


def test_hook_yields_none_one_or_many(spark):
    df = spark.createDataFrame(ROWS, "id long, text string")
    out = hooks.expand(df, words, ["text"], OUT)
    assert _told(out) == WANT
    good, failed = hooks.split(out)
    assert good.count() == 7 and {r.reject_reason for r in failed.collect()} == {hooks.REASON}
    assert [tuple(r) for r in errors_by_stage(failed).collect()] == [("processing", 3)]
    assert hooks.expand(df.where("false"), words, ["text"], OUT).count() == 0
    with pytest.raises(ValueError):
        hooks.expand(df.withColumn("word", F.lit("x")), words, ["text"], OUT)


def test_hook_on_a_stream(spark, scratch):
    spark.createDataFrame(ROWS, "id long, text string").repartition(3).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema("id long, text string").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    q = (hooks.expand(stream, words, ["text"], OUT).writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert _told(spark.read.parquet(f"{scratch}/out")) == WANT


def _table(spark, scratch, name):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("amount", T.DecimalType(4, 2)),
                           T.StructField("day", T.DateType()), T.StructField("on", T.BooleanType())])
    tables.create_table(spark, name, schema, path=f"{scratch}/{name}")
    return spark.createDataFrame([("1", "12.346", "2024-01-02", "true"), ("2", "123", "2024-01-02", "no way"), ("x", "1", None, None),
                                  (None, "1", "2024-01-02", "false"), ("99999999999", "1", "2024-01-02", None), ("3", None, "soon", None)],
                                 "id string, amount string, day string, on string")


def test_rows_that_the_stored_table_does_not_take(spark, scratch):
    rows = _table(spark, scratch, "t_dead")
    good, bad = tables.fit_to_table(rows, "t_dead")
    assert [tuple(r) for r in good.collect()] == [(1, Decimal("12.35"), dt.date(2024, 1, 2), True)]
    assert sorted((r.error, r.error_field, r.row) for r in bad.collect()) == sorted([
        ("cast_failed", "amount", '{"id":"2","amount":"123","day":"2024-01-02","on":"no way"}'),
        ("cast_failed", "id", '{"id":"x","amount":"1"}'),
        ("required_null", "id", '{"amount":"1","day":"2024-01-02","on":"false"}'),
        ("cast_failed", "id", '{"id":"99999999999","amount":"1","day":"2024-01-02"}'),
        ("cast_failed", "day", '{"id":"3","day":"soon"}')])
    with pytest.raises(ValueError):
        tables.fit_to_table(rows.withColumn("other", F.lit(1)), "t_dead")
    good, bad = tables.fit_to_table(rows.select("amount"), "t_dead")  # a REQUIRED column that the rows lack
    assert good.count() == 0 and {r.error_field for r in bad.collect()} == {"amount", "id"}


def test_a_retried_batch_writes_nothing_twice(spark, scratch):
    rows = _table(spark, scratch, "t_dead2")
    for _ in range(2):
        tables.store_batch(rows, 4, "t_dead2", f"{scratch}/kept", f"{scratch}/dead")
    assert spark.read.parquet(f"{scratch}/kept").count() == 1 and spark.read.parquet(f"{scratch}/dead").count() == 5
