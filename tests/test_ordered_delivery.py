"""Messages leave a stream in publish order per key, whatever the order of arrival."""

import datetime as dt
import os
import random
from collections import defaultdict

from spindle.schemas import MESSAGE
from spindle.streaming.ordered import late_rows, start_delivery

T0 = dt.datetime(2024, 1, 1)


def _write(spark, src, chunks, first=0):
    os.makedirs(src, exist_ok=True)
    for i, c in enumerate(chunks):
        rows = [(f"{k}{t}".encode(), {"k": k or ""}, k, f"m{n:05d}", T0 + dt.timedelta(milliseconds=t)) for k, t, n in c]
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(f"{src}/f{first + i:03d}")


def _run(spark, scratch):
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in/*")
    q = start_delivery(stream, f"{scratch}/out", checkpoint=f"{scratch}/ck", lateness="10 seconds", available_now=True)
    q.awaitTermination(300)
    return q


def _delivered(spark, scratch):
    out = defaultdict(list)
    for r in spark.read.parquet(f"{scratch}/out").collect():
        out[r.ordering_key].append((r.delivery, r.publish_time, r.message_id, bytes(r.value)))
    return {k: sorted(v) for k, v in out.items()}


def test_delivery_is_in_publish_order_and_survives_a_restart(spark, scratch):
    rnd = random.Random(1)
    sent = [(rnd.choice(["hot"] * 8 + ["a", "b"]), rnd.randrange(60_000), n) for n in range(800)]
    sent += [("a", 30_000, 900), ("a", 30_000, 899), (None, 5, 901)]  # a tie, and a message without a key
    arrival = sorted(sent, key=lambda m: m[1] + rnd.randrange(8_000))
    size = -(-len(arrival) // 8)
    chunks = [arrival[i:i + size] for i in range(0, len(arrival), size)]
    _write(spark, f"{scratch}/in", chunks[:4])
    _run(spark, scratch)
    part = _delivered(spark, scratch)
    assert 0 < len(part["hot"]) < sum(m[0] == "hot" for m in sent)
    _write(spark, f"{scratch}/in", [*chunks[4:], [("a", 1, 950)], [("end", 200_000, 990)], [("end", 200_001, 991)]], first=4)
    q = _run(spark, scratch)
    got = _delivered(spark, scratch)
    assert late_rows(q) == 1  # number 950 came 50 seconds late
    for key in ("hot", "a", "b"):
        want = sorted((T0 + dt.timedelta(milliseconds=t), f"m{n:05d}") for k, t, n in sent if k == key)
        assert [g[0] for g in got[key]] == list(range(len(want)))
        assert [(g[1], g[2]) for g in got[key]] == want
        assert [g[:3] for g in got[key]][:len(part.get(key, []))] == [g[:3] for g in part.get(key, [])]
    # what stays in the state is within the lateness: all keys' messages but the last ones have left
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 20 and None not in got
