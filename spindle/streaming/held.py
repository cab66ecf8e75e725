"""Alert rules that must hold for a duration, evaluated on the stream itself.

Closed buckets (``alerting.closed_buckets``) go to a state machine per (rule, series), which keeps
a few numbers and one event-time timer. An alert is emitted when the duration is reached and again when the run
ends; each once, also after a restart, as the state belongs to the checkpoint.

* GT rules, and LT rules that no missing bucket can breach, keep the first and the last bucket of the current run. A
  bucket that is missing ends it: the timer waits for the end of the bucket after the last one.
* LT rules with a positive threshold, where a missing bucket counts 0, keep the last bucket that did *not* breach; the
  timer stands where the duration will be full, and so fires when nothing arrives at all. A series that
  has never sent a point is known only if it is given as expected.

The runs equal those of ``operators.alerts.evaluate`` over the same points.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from spindle.operators.alerts import MAX_BROADCAST_RULES
from spindle.session import stream_checkpoint
from spindle.streaming.alerting import closed_buckets
from spindle.streaming.state import timed_state

RAISED, CLEARED = "raised", "cleared"
EVENTS = "rule string, series string, event string, start_s long, at_s long, buckets long"
#: What is written of an event.
ALERT_EVENTS = "rule string, series string, event string, start_time timestamp, at timestamp, buckets long"
#: first: start of the run, or of the time without an unbreached bucket; last: its last bucket.
STATE = "first long, last long, raised boolean, timer long"


class Rule(NamedTuple):
    less: bool
    threshold: float
    duration: int
    period: int

    @property
    def filled(self) -> bool:
        """Whether a missing bucket counts 0 and breaches."""
        return self.less and self.threshold > 0

    def breached(self, value: float | None) -> bool:
        return value is not None and (value < self.threshold if self.less else value > self.threshold)

    @property
    def full(self) -> int:
        """Seconds from a run's start to the end of the bucket with which it is long enough."""
        return max(1, -(-self.duration // self.period)) * self.period


def rule_map(rules: DataFrame) -> dict[str, Rule]:
    """Rules are configuration: a bounded table that the processor carries."""
    rows = rules.select("rule", "comparison", "threshold", "duration_s", "period_s").limit(MAX_BROADCAST_RULES + 1).collect()
    if len(rows) > MAX_BROADCAST_RULES:
        raise ValueError(f"more than {MAX_BROADCAST_RULES} rules")
    return {r["rule"]: Rule(r["comparison"] == "LT", r["threshold"], r["duration_s"], r["period_s"]) for r in rows}


class Machine:
    """The transitions of one (rule, series), without Spark: buckets and timers in, events out."""

    def __init__(self, rule: Rule, first: int | None = None, last: int | None = None, raised: bool = False) -> None:
        self.rule, self.first, self.last, self.raised = rule, first, last, raised
        self.out: list[tuple[str, int, int, int]] = []  # event, start, at, buckets

    @property
    def timer(self) -> int | None:
        """When the machine wants to be asked again, in epoch seconds."""
        if self.first is None or self.rule.filled and self.raised:
            return None
        return self.first + self.rule.full if self.rule.filled else self.last + 2 * self.rule.period

    def _raise(self, at: int) -> None:
        self.raised = True
        self.out.append((RAISED, self.first, at, (at - self.first) // self.rule.period))

    def _end(self, at: int) -> None:
        if self.raised:
            self.out.append((CLEARED, self.first, at, (at - self.first) // self.rule.period))
        self.first, self.last, self.raised = None, None, False

    def bucket(self, at: int, value: float | None) -> None:
        rule = self.rule
        if rule.filled:
            if self.first is None:
                self.first = at
            if value is not None and value >= rule.threshold:
                if not self.raised and at - self.first >= rule.full:
                    self._raise(self.first + rule.full)
                self._end(at)
                self.first = at + rule.period
            return
        if self.first is not None and at != self.last + rule.period:
            self._end(self.last + rule.period)
        if not rule.breached(value):
            if self.first is not None:
                self._end(at)
            return
        self.first, self.last = at if self.first is None else self.first, at
        if not self.raised and at + rule.period - self.first >= rule.full:
            self._raise(at + rule.period)

    def expire(self, at: int) -> None:
        if self.timer is None or at < self.timer:
            return
        if self.rule.filled:
            self._raise(self.timer)
        else:
            self._end(self.last + self.rule.period)


class HeldBreaches(StatefulProcessor):
    """``Machine`` under Spark's state and timers."""

    def __init__(self, rules: dict[str, Rule], start: int | None) -> None:
        self.rules, self.start = rules, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("run", STATE)

    def _first(self, rule: Rule) -> int | None:
        return None if self.start is None or not rule.filled else self.start // rule.period * rule.period

    def _load(self, key: tuple) -> tuple[Machine, int | None]:
        rule, row = self.rules[key[0]], self.state.get()
        if row is None:
            return Machine(rule, self._first(rule)), None
        return Machine(rule, row[0], row[1], row[2]), row[3]

    def _keep(self, key: tuple, machine: Machine, timer: int | None) -> Iterator[Row]:
        if machine.timer != timer:
            if timer is not None and timer * 1000 in set(self.handle.listTimers()):
                self.handle.deleteTimer(timer * 1000)
            if machine.timer is not None:
                self.handle.registerTimer(machine.timer * 1000)
        if machine.first is None:
            self.state.clear()
        else:
            self.state.update((machine.first, machine.last, machine.raised, machine.timer))
        for event, start, at, buckets in machine.out:
            yield Row(rule=key[0], series=key[1], event=event, start_s=start, at_s=at, buckets=buckets)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        machine, timer = self._load(key)
        for at, value in sorted((r["bucket_s"], r["value"]) for r in rows):
            machine.bucket(at, value)
        yield from self._keep(key, machine, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        machine, _ = self._load(key)
        machine.expire(expiredTimerInfo.getExpiryTimeInMs() // 1000)
        yield from self._keep(key, machine, None)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        machine = Machine(self.rules[key[0]], self._first(self.rules[key[0]]))
        for _ in self._keep(key, machine, None):
            pass


def held_alerts(points: DataFrame, rules: DataFrame, lateness: str, start: int | None = None,
                expected: DataFrame | None = None) -> DataFrame:
    """Stream of (rule, series, event, start_time, at, buckets). ``start``: epoch seconds from which LT
    rules are evaluated, as the interval of the batch form; without it, a series' first bucket. ``expected``:
    (rule, series) of LT rules that must send from ``start`` on; the series is the canonical label text."""
    mapped = rule_map(rules)
    buckets = (closed_buckets(points, rules, lateness)
               .select("rule", "series", F.unix_seconds("bucket").alias("bucket_s"), "value"))
    known = None
    if expected is not None:
        if start is None:
            raise ValueError("expected series need a start")
        filled = [name for name, r in mapped.items() if r.filled]
        known = expected.where(F.col("rule").isin(filled)).select("rule", "series").distinct().groupBy("rule", "series")
    events = buckets.groupBy("rule", "series").transformWithState(
        HeldBreaches(mapped, start), EVENTS, "append", "eventTime", initialState=known)
    return events.select("rule", "series", "event", F.timestamp_seconds("start_s").alias("start_time"),
                         F.timestamp_seconds("at_s").alias("at"), "buckets")


def start_held_alerts(points: DataFrame, rules: DataFrame, path: str, checkpoint: str | None = None,
                      lateness: str = "300 seconds", start: int | None = None, expected: DataFrame | None = None,
                      available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Write every alert event once: a micro-batch that is replayed rewrites its own folder."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    spark = points.sparkSession
    writer = (held_alerts(points, rules, lateness, start, expected).writeStream.outputMode("append")
              .foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint or stream_checkpoint(spark, "held-alerts", path)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    with timed_state(spark):
        return writer.start()
