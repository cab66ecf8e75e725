"""Exports at two periods from one query, and percentiles from merged sketches."""

import datetime as dt
import os
import random
from collections import defaultdict

import pytest

from spindle.operators import rollup as ru
from spindle.schemas import METRICS
from spindle.streaming.export import export_rows, start_export

T0 = dt.datetime(2024, 1, 1)


def _points(spark, rows):
    return spark.createDataFrame(
        [("latency/x", "GAUGE", "DOUBLE", v, {"s": s}, {}, T0 + dt.timedelta(seconds=t)) for s, t, v in rows], METRICS)


def _figures(rows):
    return {(r.series, r.bucket): (round(r["sum"], 6), r.n, r["min"], r["max"]) for r in rows}


def _want(rows, period):
    out = defaultdict(list)
    for s, t, v in rows:
        if v is not None:
            out['{"s":"%s"}' % s, T0 + dt.timedelta(seconds=t // period * period)].append(v)
    return {k: (round(sum(v), 6), len(v), min(v), max(v)) for k, v in out.items()}


def test_hourly_export_is_the_rollup_of_the_short_one(spark, scratch):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), rnd.randrange(3 * 3600), rnd.choice([None, 1.5, 2.25, -3.0, 8.0])) for _ in range(900)]
    arrival = sorted(rows, key=lambda r: r[1] + rnd.randrange(200))
    chunks = [arrival[i:i + 150] for i in range(0, 900, 150)] + [[("z", 9 * 3600, 0.0)], [("z", 9 * 3600 + 1, 0.0)]]
    os.makedirs(f"{scratch}/pts")
    def run(chunk_range):
        for i in chunk_range:
            _points(spark, chunks[i]).coalesce(1).write.parquet(f"{scratch}/pts/f{i:03d}")
        stream = spark.readStream.schema(METRICS).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/pts/*")
        start_export(stream, {300: f"{scratch}/short", 3600: f"{scratch}/long"}, checkpoint=f"{scratch}/ck",
                     available_now=True).awaitTermination(300)
    run(range(3))
    run(range(3, len(chunks)))  # a restart on the same checkpoint
    short, long = (spark.read.parquet(f"{scratch}/{n}") for n in ("short", "long"))
    assert _figures(short.collect()) == _want(rows, 300) and short.count() == len(_want(rows, 300))
    assert _figures(long.collect()) == _want(rows, 3600) and long.count() == 6
    again = ru.stored(ru.coarser(ru.rollup(_points(spark, rows), 300), 3600))
    assert _figures(again.collect()) == _want(rows, 3600)
    merged = ru.merge_stored(short, ["series"])
    assert {r.series: r.n for r in merged.collect()} == {r.series: r.n for r in ru.merge_stored(long, ["series"]).collect()}


def test_a_days_percentiles_from_five_minute_rows(spark):
    rnd = random.Random(6)
    rows = [(s, rnd.randrange(86_400), rnd.lognormvariate(0, 2) if s == "a" else float(rnd.randrange(50)))
            for s in "ab" for _ in range(20_000)] + [("few", i, float(i)) for i in range(100)]
    day = ru.merge_stored(ru.stored(ru.rollup(_points(spark, rows), 300)))
    values = defaultdict(list)
    for s, _, v in rows:
        values['{"s":"%s"}' % s].append(v)
    got = ru.quantiles(day, (0.5, 0.95, 0.99)).collect()
    assert len(got) == 9
    for r in got:
        own = sorted(values[r.series])
        below, upto = sum(v < r.value for v in own) / len(own), sum(v <= r.value for v in own) / len(own)
        error = 1 / len(own) if r.series == '{"s":"few"}' else ru.RANK_ERROR
        assert below - error <= r.p <= upto + error


def test_periods_must_nest(spark):
    for periods in ((), (300, 400), (3600, 300), (300, 300)):
        with pytest.raises(ValueError):
            export_rows(_points(spark, []), periods)
