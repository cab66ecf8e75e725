"""Publish batches against a plain loop over the messages."""

import datetime as dt
import random

import numpy as np
import pytest

from spindle.schemas import MESSAGE
from spindle.sources.batches import Limits, Stretch, batch_numbers, batch_sizes, with_batches

T0 = dt.datetime(2024, 1, 1)


def _loop(limits, rows):
    """[(key, at, id, size)] in order -> batch numbers by the rule itself."""
    out, key, count, held, first, number = [], object(), 0, 0, 0, 0
    for k, at, _, size in rows:
        if k != key:
            key, count, number = k, 0, -1
        if not count or count + 1 > limits.max_messages or held + size > limits.max_bytes or at - first > limits.max_latency_us:
            count, held, first, number = 0, 0, at, number + 1
        count, held = count + 1, held + size
        out.append(number)
    return out


def _messages(rnd, n, keys=("a", "b", None)):
    rows = [(rnd.choice(["hot", "hot", *keys]), rnd.randrange(n * 400), f"m{i:05d}", rnd.choice([0, 1, 10, 200, 900, 5000]))
            for i in range(n)]
    return rows + rows[:5]  # repeated messages


@pytest.mark.parametrize("limits,part_rows,fan", [
    (Limits(7, 2000, 5000), 40, 2), (Limits(100, 1_000_000, 10**9), 60, 3), (Limits(1, 10, 0), 100, 64),
    (Limits(1000, 3000, 10**9), 25, 2), (Limits(50, 10**9, 20_000), 500_000, 64)])
def test_batches_equal_a_plain_loop(spark, limits, part_rows, fan):
    rows = _messages(random.Random(part_rows), 600)
    df = spark.createDataFrame([(b"x" * s, {}, k, i, T0 + dt.timedelta(microseconds=t)) for k, t, i, s in rows], MESSAGE)
    got = with_batches(df.repartition(3), limits, part_rows, fan).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    want = sorted(zip([(r[0] or "", r[2]) for r in order], _loop(limits, order)))
    assert sorted(((r.ordering_key or "", r.message_id), r.batch) for r in got) == want
    for b in batch_sizes(with_batches(df, limits, part_rows, fan)).collect():
        span = (b.last_time - b.first_time) / dt.timedelta(microseconds=1)
        assert b.messages <= limits.max_messages and span <= limits.max_latency_us
        assert b.bytes <= limits.max_bytes or b.messages == 1 or b.bytes == 5000 and limits.max_bytes < 5000


@pytest.mark.parametrize("seed", range(40))
def test_tables_of_stretches_compose(seed):
    """Whatever way the messages are cut into stretches, the open batch behind them is the same."""
    rnd = random.Random(seed)
    limits = Limits(rnd.choice([1, 3, 8]), rnd.choice([50, 1000]), rnd.choice([100, 10_000]))
    rows = sorted((rnd.choice("ab"), rnd.randrange(3000), str(i), rnd.choice([1, 40, 400])) for i in range(rnd.choice([2, 30, 120])))
    want = _loop(limits, rows)
    cuts = sorted({0, len(rows), *(rnd.randrange(len(rows)) for _ in range(12))})
    parts = []
    for lo, hi in zip(cuts, cuts[1:]):
        own = rows[lo:hi]
        keys = [i for i in range(len(own)) if i == 0 or own[i][0] != own[i - 1][0]]
        runs = [(own[a][0], a, b) for a, b in zip(keys, [*keys[1:], len(own)])]
        parts.append(Stretch.of(limits, runs, np.array([r[3] for r in own]), np.array([r[1] for r in own])))
    while len(parts) > 1:
        i = rnd.randrange(len(parts) - 1)
        n = rnd.choice([2, 2, 3])
        parts[i:i + n] = [Stretch.join(limits, parts[i:i + n])]
    key, count, _, first, number = parts[0].enter(limits, None)
    last = [r for r, b in zip(rows, want) if r[0] == rows[-1][0] and b == want[-1]]
    assert (key, count, first, number) == (rows[-1][0], len(last), last[0][1], want[-1])


def test_limits_and_no_rows(spark):
    with pytest.raises(ValueError):
        Limits(0)
    assert with_batches(spark.createDataFrame([], MESSAGE), Limits()).count() == 0
    assert batch_numbers(Limits(2, 10, 10), np.array([20, 1, 1, 1]), np.array([0, 0, 0, 0]), 0, -1).tolist() == [0, 1, 1, 2]
