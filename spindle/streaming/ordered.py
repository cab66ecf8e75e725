"""Ordered delivery per key on a stream.

A message is held until the watermark of the publish time has passed it; nothing earlier can then
still be on its way (but for late rows). Each key has a list of held messages and one
timer at its earliest one; the list's elements are chunks of messages. When the timer fires, all messages up to the watermark leave in the order
of (publish time, message id), each with the next delivery number of its key, and the others stay. A key's state
is what it published within the lateness, however long the stream runs. Messages without an ordering key
need no order and are no part of this.

Rows later than the lateness are dropped by Spark before they reach the state and are counted in the
progress of the query (``late_rows``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from spindle.session import stream_checkpoint
from spindle.streaming.state import timed_state

HELD = "at_us long, message_id string, value binary, attributes map<string,string>"
DELIVERED = f"ordering_key string, delivery long, {HELD}"
CHUNK_ROWS = 5_000
ARROW_HELD = pa.schema([("at_us", pa.int64()), ("message_id", pa.string()), ("value", pa.binary()),
                        ("attributes", pa.map_(pa.string(), pa.string()))])


def pack(messages: list[tuple]) -> list[tuple[bytes]]:
    """Held messages as elements of the list state, each an Arrow batch: the state is asked per chunk, not per message."""
    out = []
    for i in range(0, len(messages), CHUNK_ROWS):
        at, ids, values, attributes = zip(*messages[i:i + CHUNK_ROWS])
        attributes = [[*a.items()] if isinstance(a, dict) else a for a in attributes]
        batch = pa.record_batch([pa.array(c, f.type) for c, f in zip((at, ids, values, attributes), ARROW_HELD)], schema=ARROW_HELD)
        out.append((batch.serialize().to_pybytes(),))
    return out


def unpack(chunk: bytes) -> list[tuple]:
    batch = pa.ipc.read_record_batch(pa.py_buffer(bytes(chunk)), ARROW_HELD)
    return [*zip(*(c.to_pylist() for c in batch.columns))]


class Reorder(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "chunk binary")
        self.sent = handle.getValueState("sent", "delivery long, timer long")

    def _turn(self, key: tuple, new: list[tuple], watermark_ms: int) -> Iterator[pd.DataFrame]:
        row = self.sent.get()
        delivery, timer = (0, None) if row is None else (row[0], row[1])
        if timer is not None and timer > watermark_ms and (not new or min(n[0] for n in new) > watermark_ms * 1000):
            # nothing is due: the new ones are only added
            if new:
                self.held.appendList(pack(new))
            due, rest = [], None
            earliest = min([timer, *(-(-n[0] // 1000) for n in new)])
        else:
            every = sorted([*(m for row in self.held.get() for m in unpack(row[0])), *new], key=lambda m: (m[0], m[1] or ""))
            cut = sum(m[0] <= watermark_ms * 1000 for m in every)
            due, rest = every[:cut], every[cut:]
            earliest = -(-rest[0][0] // 1000) if rest else None
        if rest is not None:
            if rest:
                self.held.put(pack(rest))
            else:
                self.held.clear()
        if earliest != timer:
            if timer is not None and timer in set(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if earliest is not None:
                self.handle.registerTimer(earliest)
        self.sent.update((delivery + len(due), earliest))
        for i in range(0, len(due), CHUNK_ROWS):
            at_us, ids, values, attributes = zip(*due[i:i + CHUNK_ROWS])
            attributes = [None if a is None else dict(a) for a in attributes]
            first = delivery + i
            yield pd.DataFrame({"ordering_key": key[0], "delivery": range(first, first + len(ids)), "at_us": at_us, "message_id": ids,
                                "value": values, "attributes": pd.Series(attributes, dtype=object)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [m for pdf in rows for m in zip(*(pdf[c].tolist() for c in ARROW_HELD.names))]
        yield from self._turn(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._turn(key, [], timerValues.getCurrentWatermarkInMs())


def in_order(messages: DataFrame, lateness: str) -> DataFrame:
    """Stream of the keyed messages in their keys' publish order, with a gapless ``delivery`` number from 0 per key."""
    held = (messages.where("ordering_key IS NOT NULL").withWatermark("publish_time", lateness)
            .withColumn("at_us", F.unix_micros("publish_time"))
            .select("ordering_key", "publish_time", "at_us", "message_id", "value", "attributes"))
    out = held.groupBy("ordering_key").transformWithStateInPandas(Reorder(), DELIVERED, "append", "eventTime")
    return out.select("ordering_key", "delivery", "message_id", "value", "attributes",
                      F.timestamp_micros("at_us").alias("publish_time"))


def start_delivery(messages: DataFrame, path: str, checkpoint: str | None = None, lateness: str = "300 seconds",
                   available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Deliver to files; a file has a key's messages in order, and ``delivery`` orders them across files."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    spark = messages.sparkSession
    writer = (in_order(messages, lateness).writeStream.outputMode("append").foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint or stream_checkpoint(spark, "delivery", path)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    with timed_state(spark):
        return writer.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late, over the progress reports that the query still holds."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
