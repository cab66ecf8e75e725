"""Alerts held for a duration on a stream, against the batch evaluation of the same points."""

import datetime as dt
import os
import random

import pytest

from spindle.operators import alerts as al
from spindle.schemas import METRICS
from spindle.streaming.held import CLEARED, RAISED, Machine, Rule, held_alerts, start_held_alerts

T0 = dt.datetime(2024, 1, 1)
S0 = 1704067200


def _points(spark, rows):
    return spark.createDataFrame(
        [("latency/x", "GAUGE", "DOUBLE", float(v), {"s": s}, {}, T0 + dt.timedelta(seconds=t))
         for s, t, v in rows], METRICS)


def _write(spark, src, chunks, first=0):
    os.makedirs(src, exist_ok=True)
    for i, c in enumerate(chunks):
        _points(spark, c).coalesce(1).write.parquet(f"{src}/f{first + i:03d}")


def _run(spark, scratch, rules, **options):
    stream = spark.readStream.schema(METRICS).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/pts/*")
    q = start_held_alerts(stream, rules, f"{scratch}/alerts", checkpoint=f"{scratch}/ck", available_now=True, **options)
    q.awaitTermination(300)


def _events(spark, scratch):
    return [(r.rule, r.series, r.event, r.start_time, r["at"], r.buckets)
            for r in spark.read.parquet(f"{scratch}/alerts").collect()]


def _rules(spark):
    return al.rules_frame(spark, [
        al.rule("high", "latency/x", "GT", 5, duration_s=180, period_s=60, aligner="max"),
        al.rule("low", "latency/x", "LT", 5, duration_s=120, period_s=60, aligner="sum"),
        al.rule("never_filled", "latency/x", "LT", 0, duration_s=60, period_s=60, aligner="min"),
    ])


def test_stream_alerts_equal_the_batch_runs(spark, scratch):
    """Ten micro-batches with late points and an outage, a restart halfway, each event once."""
    rnd = random.Random(11)
    rows = [(s, 60 * m + rnd.randrange(60), rnd.choice([-1, 0, 3, 8, 12, 12])) for m in range(120) for s in ("a", "b")
            if not (s == "b" and 40 <= m < 60) and rnd.random() < 0.85]
    arrival = sorted(rows, key=lambda r: r[1] + (150 if rnd.random() < 0.2 else 0))
    size = -(-len(arrival) // 10)
    chunks = [arrival[i:i + size] for i in range(0, len(arrival), size)]
    end = [("z", 3 * 3600 + 60 * i, 12) for i in range(2)]  # carries the watermark on
    rules = _rules(spark)
    _write(spark, f"{scratch}/pts", chunks[:5])
    _run(spark, scratch, rules, lateness="300 seconds")
    before = _events(spark, scratch)
    assert before
    _write(spark, f"{scratch}/pts", [*chunks[5:], end[:1], end[1:]], first=5)
    _run(spark, scratch, rules, lateness="300 seconds")
    got = [e for e in _events(spark, scratch) if '"z"' not in e[1]]
    assert set(before) <= set(got) and len(got) == len(set(got))

    # The batch form fills from a rule's first bucket; the stream from a series' own: give both the same series.
    want = {}
    for s in ("a", "b"):
        own = _points(spark, [r for r in rows if r[0] == s])
        last = max(r[1] for r in rows if r[0] == s) // 60 * 60
        for r in al.evaluate(own, rules).collect():
            want[r.rule, r.series, r.start_time] = (r.end_time, r.buckets, (r.end_time - T0).total_seconds() > last)
    raised = {e[0:2] + (e[3],) for e in got if e[2] == RAISED}
    cleared = {e[0:2] + (e[3],): (e[4], e[5]) for e in got if e[2] == CLEARED}
    open_after = {k for k in raised if k not in want}  # outages after the last point of a series
    assert set(want) <= raised and all(k[0] == "low" for k in open_after) and len(want) > 8
    assert {r for r, *_ in want} == {"high", "low", "never_filled"}
    for k, (end_time, buckets, last) in want.items():
        assert cleared.get(k) == (end_time, buckets) or (last and k[0] == "low")


def test_silence_raises_without_any_row(spark, scratch):
    """An expected series that never sends, and one that stops, raise as the watermark passes."""
    rules = _rules(spark).where("rule = 'low'")
    alive = [[("a", 60 * m, 9) for m in range(4 * i, 4 * i + 4)] for i in range(6)]
    stops = [("b", 60 * m, 9) for m in range(4)]
    _write(spark, f"{scratch}/pts", [alive[0] + stops, *alive[1:]])
    expected = spark.createDataFrame([("low", '{"s":"c"}'), ("high", '{"s":"c"}')], "rule string, series string")
    _run(spark, scratch, rules, lateness="60 seconds", start=S0, expected=expected)
    got = sorted(e[1:] for e in _events(spark, scratch))
    t = lambda s: T0 + dt.timedelta(seconds=s)
    assert got == [('{"s":"b"}', RAISED, t(240), t(360), 2), ('{"s":"c"}', RAISED, t(0), t(120), 2)]


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("rule", [Rule(False, 5, 180, 60), Rule(True, 5, 100, 60), Rule(True, -1, 60, 60)])
def test_machine_counts_runs_like_a_grid(rule, seed):
    rnd = random.Random(seed)
    given = {60 * i: rnd.choice([-2, 0, 9]) for i in range(60) if i == 0 or rnd.random() < 0.7}
    machine = Machine(rule, 0 if rule.filled else None)
    for at in range(0, 3600, 60):
        if at in given:
            machine.bucket(at, given[at])
        if machine.timer is not None and machine.timer <= at + 60:
            machine.expire(at + 60)
    runs, start = [], None
    for at in [*range(0, 3600, 60), 3600]:
        value = given.get(at, 0 if rule.filled else None) if at < 3600 else None
        hit = at < 3600 and rule.breached(value)
        if hit and start is None:
            start = at
        if not hit and start is not None:
            if at - start >= rule.duration:
                runs.append((start, at))
            start = None
    closed = [(s, at) for e, s, at, _ in machine.out if e == CLEARED]
    assert [s for e, s, *_ in machine.out if e == RAISED] == [s for s, _ in runs]
    assert closed == [r for r in runs if r[1] < 3600] and all(n == (at - s) // 60 for _, s, at, n in machine.out)


def test_expected_series_need_a_start(spark):
    with pytest.raises(ValueError):
        held_alerts(_points(spark, []), _rules(spark), "1 seconds", expected=spark.createDataFrame([], "rule string, series string"))
