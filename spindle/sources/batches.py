"""Publish batches limited by count, bytes and latency.

A publisher fills one batch per ordering key. A message opens the next batch when with it the open one would hold
more than ``max_messages``, or more than ``max_bytes``, or when it comes more than ``max_latency``
after the batch's first message; a message larger than ``max_bytes`` is a batch of its own. Where a
batch ends depends on where it began, a running sum with resets that window functions do not have.

From a given first message the end is fixed, so a stretch of a key's messages is a function from
the open batch that comes in to the one that goes out. As a batch has ``max_messages`` at most, an incoming batch ends
within that many messages: the function is a short table, whatever the stretch's length, and two tables make the
table of both stretches together. The messages are therefore ranged into parts by (key, time), each part gives its
table, tables are joined in groups of ``fan`` until few are left, the open batches are handed down again, and every
part cuts its own messages. A key may fill any number of parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.session import materialize

PART_ROWS = 100_000  # a part is held by a Python worker, with the copies that sorting makes
FAN = 64

#: The open batch after some messages: its key, messages, bytes, first time, and number within the key.
Open = tuple[str | None, int, int, int, int]


@dataclass(frozen=True)
class Limits:
    max_messages: int = 100
    max_bytes: int = 1_000_000
    max_latency_us: int = 10_000

    def __post_init__(self) -> None:
        if min(self.max_messages, self.max_bytes) < 1 or self.max_latency_us < 0:
            raise ValueError("limits must be positive")

    def following(self, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For every message of one key the first one that a batch begun there does not hold."""
        n = len(size)
        total = np.r_[0, np.cumsum(size)]
        here = np.arange(n)
        by_bytes = np.searchsorted(total, total[:-1] + self.max_bytes, side="right") - 1
        by_time = np.searchsorted(at, at + self.max_latency_us, side="right")
        return np.maximum(here + 1, np.minimum.reduce([here + self.max_messages, by_bytes, by_time]))

    def fits(self, count: int, held: int, first: int, total: np.ndarray, at: np.ndarray) -> int:
        """How many of the messages that follow an open batch still go into it; ``total``: bytes up to and with each."""
        return int(min(self.max_messages - count, np.searchsorted(total, self.max_bytes - held, side="right"),
                       np.searchsorted(at, first + self.max_latency_us, side="right"), len(total)))


def batch_numbers(limits: Limits, size: np.ndarray, at: np.ndarray, skip: int, number: int) -> np.ndarray:
    """Batch numbers of one key's messages; the first ``skip`` belong to batch ``number``, others follow."""
    following, starts, i = limits.following(size, at), [], skip
    while i < len(size):  # one step per batch
        starts.append(i)
        i = int(following[i])
    opened = np.zeros(len(size), np.int64)
    opened[starts] = 1
    return number + np.cumsum(opened)


@dataclass
class Stretch:
    """The table of a stretch. ``head`` has (bytes with it, time) of the first messages of its first key; ``after`` the
    batch that is open at the end of that key's messages if a batch begins at that one (messages, bytes, first
    time, batches begun). ``rows`` and ``held`` count the first key's messages; ``end`` is the open batch of
    the last key where that is another."""

    first: str | None
    rows: int
    held: int
    head: np.ndarray
    after: np.ndarray
    end: Open | None

    def enter(self, limits: Limits, before: Open | None) -> Open:
        """The batch that is open behind the stretch."""
        if self.end is not None:
            return self.end
        return self.through(limits, before)

    def through(self, limits: Limits, before: Open | None) -> Open:
        """The batch that is open behind the first key's messages."""
        at, number = 0, -1
        if before is not None and before[0] == self.first:
            _, count, held, first, number = before
            at = limits.fits(count, held, first, self.head[:, 0], self.head[:, 1])
            if at >= self.rows:
                return self.first, count + self.rows, held + self.held, first, number
        count, held, first, begun = self.after[at].tolist()
        return self.first, count, held, first, number + begun

    @staticmethod
    def of(limits: Limits, keys: list, size: np.ndarray, at: np.ndarray) -> Stretch:
        """From a part's messages in order; keys are the (key, from, to) of its runs."""
        key, lo, hi = keys[0]
        s, t = size[lo:hi], at[lo:hi]
        n, total = hi - lo, np.r_[0, np.cumsum(s)]
        step = np.r_[limits.following(s, t), n]
        begun = np.r_[np.ones(n, np.int64), 0]
        last = np.r_[np.arange(n), n]
        jump = step.copy()
        while (jump[:n] < n).any():  # by doubling: the last batch begun, and how many
            inside = jump < n
            last = np.where(inside, last[jump], last)
            begun = np.where(inside, begun + begun[jump], begun)
            jump = jump[jump]
        few = min(n, limits.max_messages)
        head = np.stack([total[1:few + 1], t[:few]], axis=1)
        open_ = last[:few]
        after = np.stack([n - open_, total[n] - total[open_], t[open_], begun[:few]], axis=1)
        end = None
        if len(keys) > 1:
            other, a, b = keys[-1]
            end = Stretch.of(limits, [(other, a, b)], size, at).through(limits, None)
        return Stretch(key, n, int(total[n]), head, after, end)

    @staticmethod
    def join(limits: Limits, parts: list[Stretch]) -> Stretch:
        """The table of consecutive stretches as one."""
        first, run = parts[0], 1
        while run < len(parts) and parts[run - 1].end is None and parts[run].first == first.first:
            run += 1
        heads, afters, before, held = [], [], 0, 0
        for i, part in enumerate(parts[:run]):
            room = limits.max_messages - before
            if room > 0:
                heads.append(part.head[:room] + [held, 0])
                rows = []
                for at in range(min(room, len(part.after))):
                    count, size, start, begun = part.after[at].tolist()
                    open_: Open = (first.first, count, size, start, begun - 1)
                    for later in parts[i + 1:run]:
                        open_ = later.through(limits, open_)
                    rows.append((open_[1], open_[2], open_[3], open_[4] + 1))
                afters.append(np.array(rows, np.int64).reshape(-1, 4))
            before, held = before + part.rows, held + part.held
        end = parts[run - 1].end
        for part in parts[run:]:
            end = part.enter(limits, end)
        return Stretch(first.first, before, held, np.concatenate(heads), np.concatenate(afters), end)


TABLE = ("part long, first string, rows long, held long, head binary, after binary, end_key string, "
         "end array<long>")
OPEN = "part long, key string, open array<long>"


def _row(part: int, s: Stretch) -> tuple:
    end = (None, None) if s.end is None else (s.end[0], list(s.end[1:]))
    return part, s.first, s.rows, s.held, s.head.astype(np.int64).tobytes(), s.after.astype(np.int64).tobytes(), *end


def _stretches(pdf: pd.DataFrame) -> Iterator[tuple[int, Stretch]]:
    for r in pdf.sort_values("part").itertuples(index=False):
        end = None if r.end is None else (r.end_key, *map(int, r.end))
        yield int(r.part), Stretch(r.first, int(r.rows), int(r.held), np.frombuffer(r.head, np.int64).reshape(-1, 2),
                                   np.frombuffer(r.after, np.int64).reshape(-1, 4), end)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)


def _runs(pdf: pd.DataFrame) -> tuple[list, np.ndarray, np.ndarray]:
    keys = pdf["key"].to_numpy()
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    runs = [(keys[lo], lo, hi) for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)])]
    return runs, pdf["size"].to_numpy(np.int64), pdf["at_us"].to_numpy(np.int64)


def cut(rows: DataFrame, limits: Limits, part_rows: int = PART_ROWS, fan: int = FAN) -> DataFrame:
    """(row, batch) of rows (key, at_us, id, size, row): the number of the row's batch within its key, in the order of
    (at_us, id, row). ``row`` tells rows apart and must not change between readings; keys are not null."""
    n = rows.count()
    if not n:
        return rows.select("row", F.lit(0).cast("long").alias("batch"))
    order = ["key", "at_us", "id", "row"]
    parted = materialize(rows.select("key", "at_us", "id", "size", "row")
                         .repartitionByRange(max(1, -(-n // part_rows)), *order)
                         .withColumn("part", F.spark_partition_id().cast("long")))

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        runs, size, at = _runs(pdf.sort_values(order))
        return _frame([_row(int(pdf["part"].iloc[0]), Stretch.of(limits, runs, size, at))], TABLE)

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        return _frame([_row(int(pdf["part"].iloc[0]) // fan, Stretch.join(limits, [s for _, s in _stretches(pdf)]))], TABLE)

    levels = [materialize(parted.groupBy("part").applyInPandas(table, TABLE))]
    while levels[-1].count() > fan:
        up = F.floor(F.col("part") / fan)
        levels.append(materialize(levels[-1].groupBy(up).applyInPandas(join, TABLE)))

    def hand_down(tables: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        open_ = None
        if len(given) and given["open"].iloc[0] is not None:
            open_ = (given["key"].iloc[0], *map(int, given["open"].iloc[0]))
        out = []
        for part, stretch in _stretches(tables):
            out.append((part, open_[0] if open_ else None, list(open_[1:]) if open_ else None))
            open_ = stretch.enter(limits, open_)
        return _frame(out, OPEN)

    spark = rows.sparkSession
    opened = spark.createDataFrame([(0, None, None)], OPEN)
    for level in reversed(levels):
        up = F.floor(F.col("part") / fan) if level is not levels[-1] else F.lit(0).cast("long")
        opened = level.groupBy(up.alias("of")).cogroup(opened.groupBy(F.col("part").alias("of"))).applyInPandas(hand_down, OPEN)

    def number(pdf: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        runs, size, at = _runs(pdf)
        batch = np.empty(len(pdf), np.int64)
        for i, (key, lo, hi) in enumerate(runs):
            skip, no = 0, -1
            if i == 0 and len(given) and given["open"].iloc[0] is not None and given["key"].iloc[0] == key:
                count, held, first, no = map(int, given["open"].iloc[0])
                skip = limits.fits(count, held, first, np.cumsum(size[lo:hi]), at[lo:hi])
            batch[lo:hi] = batch_numbers(limits, size[lo:hi], at[lo:hi], skip, no)
        return pd.DataFrame({"row": pdf["row"].to_numpy(np.int64), "batch": batch})

    return parted.groupBy("part").cogroup(opened.groupBy("part")).applyInPandas(number, "row long, batch long")


def with_batches(messages: DataFrame, limits: Limits, part_rows: int = PART_ROWS, fan: int = FAN) -> DataFrame:
    """``messages`` plus ``size`` (bytes of the value) and ``batch``, numbered from 0 within the ordering key in publish
    order; messages without a key share one. The rows are stored first, so that both readings number them alike."""
    stored = materialize(messages.withColumn("_row", F.monotonically_increasing_id())
                         .withColumn("size", F.coalesce(F.octet_length("value"), F.lit(0)).cast("long")))
    key = F.concat(F.when(F.col("ordering_key").isNull(), F.lit("-")).otherwise(F.lit("k")), F.coalesce("ordering_key", F.lit("")))
    thin = stored.select(key.alias("key"), F.coalesce(F.unix_micros("publish_time"), F.lit(0)).alias("at_us"),
                         F.coalesce("message_id", F.lit("")).alias("id"), "size", F.col("_row").alias("row"))
    numbered = cut(thin, limits, part_rows, fan).withColumnRenamed("row", "_row")
    return stored.join(numbered, "_row").drop("_row")


def batch_sizes(batched: DataFrame) -> DataFrame:
    """One row per batch: ordering_key, batch, messages, bytes, first and last publish time."""
    return batched.groupBy("ordering_key", "batch").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("size").alias("bytes"),
        F.min("publish_time").alias("first_time"), F.max("publish_time").alias("last_time"))
