import datetime as dt
import os
import random

import pytest

from spindle.operators import alerts as al
from spindle.schemas import METRICS
from spindle.streaming.alerting import ALIGNED_SCHEMA, current_alerts, start_alerting

T0 = dt.datetime(2024, 1, 1)


def _points(spark, rows):
    """rows: (series, second, value)."""
    return spark.createDataFrame(
        [("latency/x", "GAUGE", "DOUBLE", float(v), {"s": s}, {}, T0 + dt.timedelta(seconds=t))
         for s, t, v in rows], METRICS)


def _stream(spark, scratch, chunks, rules, lateness):
    src = f"{scratch}/pts"
    os.makedirs(src)
    for i, c in enumerate(chunks):
        _points(spark, c).coalesce(1).write.parquet(f"{src}/f{i:03d}")
    stream = spark.readStream.schema(METRICS).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    q = start_alerting(stream, rules, f"{scratch}/rollup", checkpoint=f"{scratch}/ck",
                       lateness=lateness, available_now=True)
    q.awaitTermination(300)
    return sorted((r.rule, r.series, r.bucket, round(r.value, 9))
                  for r in spark.read.schema(ALIGNED_SCHEMA).parquet(f"{scratch}/rollup").collect())


def _batch(spark, rows, rules):
    return sorted((r.rule, r.series, r.bucket, round(r.value, 9))
                  for r in al.aligned_by_rule(_points(spark, rows), rules).collect())


@pytest.mark.parametrize("late", [0, 120])
def test_buckets_of_mixed_periods_lose_no_point(spark, scratch, late):
    """An hourly and a minute rule over ten micro-batches, some points ``late`` seconds late."""
    rnd = random.Random(late)
    rows = [(s, 60 * m + rnd.randrange(60), rnd.choice([0, 3, 8, 12])) for m in range(150) for s in ("a", "b")]
    arrival = sorted(rows, key=lambda r: r[1] + (late if late and rnd.random() < 0.3 else 0))
    chunks = [arrival[i:i + 30] for i in range(0, len(arrival), 30)] + [[("z", 6 * 3600, 0)], [("z", 6 * 3600 + 1, 0)]]
    rules = al.rules_frame(spark, [
        al.rule("hour", "latency/x", "GT", 5, duration_s=3600, period_s=3600, aligner="count"),
        al.rule("minute", "latency/x", "LT", 5, duration_s=120, period_s=60, aligner="sum"),
    ])
    got = _stream(spark, scratch, chunks, rules, "300 seconds")
    assert got == _batch(spark, rows, rules) and len(got) > 100
    runs = lambda df: sorted(map(tuple, df.collect()))
    assert runs(current_alerts(spark, f"{scratch}/rollup", rules)) == runs(al.evaluate(_points(spark, rows), rules))


def test_two_streams_have_their_own_default_checkpoints(spark):
    from spindle.session import stream_checkpoint

    a, b = (stream_checkpoint(spark, "ingest", p) for p in ("/x/landed", "/y/landed"))
    assert a != b and a == stream_checkpoint(spark, "ingest", "/x/landed")
