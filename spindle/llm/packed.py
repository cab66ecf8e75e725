"""Hard negatives by Kronecker-packed integer products.

Every component x becomes floor(256 x). Several candidates' components, biased so that none is
negative, stand in separated fields of one wide integer; a field is wide enough for the largest sum
that can come up. One multiplication by an anchor's biased component multiplies all of
a word's candidates, and the sum of such products over the components holds each candidate's sum in
its field:

    sum (q + B)(a + A) = q.a + A sum(q) + B sum(a) + n A B,

from which the exact score q.a is unpacked. Words have 64 bits where two fields or more fit, which numpy
multiplies as matrices; otherwise they are Python integers of any length.

The rows are packed once, in blocks. Anchors come in blocks of a bounded number, each sent to all tasks:
one pass over the packed rows finds every anchor's positives, a second one the negatives of each
(anchor, positive). A task keeps the first k of each over all its blocks, and their merging has two steps.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part; shorter vectors count as if zeros followed; an empty vector scores zero; repeated rows are rows of
their own, and each repeated anchor is answered; a row with a null vec_id is no anchor and comes last
among ties; anchors without positives, and positives without negatives, give no row; components from
``LARGEST`` and scores from ``LARGEST_SCORE`` on raise an error; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spindle.llm.common import filled, scratch_table

SCALE = 256
BLOCK_ROWS = 2048  # rows packed together
ANCHORS = 4096  # anchors that one job sends to its tasks
TILE = 256  # anchors multiplied at once
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score in hundredths of the positive's
NONE = np.iinfo(np.int64).min
LARGEST, LARGEST_SCORE = 1 << 40, 1 << 56  # of components and scores; products with 90 still have 64 bits


class Packing:
    """Field layout for components of given bounds: n of them, rows in [low, high], anchors likewise."""

    def __init__(self, n: int, low: int, high: int) -> None:
        self.bias, self.n = -low, n
        most = max(1, n * (high - low) ** 2)
        self.bits = most.bit_length()
        self.fields = 64 // self.bits
        self.wide = self.fields < 2
        if self.wide:
            self.fields = 32  # in a Python integer

    def pack(self, q: np.ndarray) -> np.ndarray:
        """(words, components) from (rows, components); absent rows of the last word count as -bias."""
        words = -(-len(q) // self.fields)
        kind = object if self.wide else np.uint64
        full = np.zeros((words * self.fields, self.n), kind)
        full[:len(q)] = (q + self.bias).astype(kind)
        full = full.reshape(words, self.fields, self.n)
        out = np.zeros((words, self.n), kind)
        for j in range(self.fields):
            shift = j * self.bits
            out += full[:, j] * (1 << shift) if self.wide else full[:, j] << np.uint64(shift)
        return out

    def scores(self, packed: np.ndarray, row_sums: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Exact inner products (rows, anchors); ``a`` holds the anchors' components, one row each."""
        biased = a + self.bias
        sums = packed @ biased.astype(object if self.wide else np.uint64).T
        mask = (1 << self.bits) - 1
        out = np.empty((len(sums), self.fields, len(a)), object if self.wide else np.int64)
        for j in range(self.fields):
            field = (sums >> (j * self.bits)) & mask if self.wide else (sums >> np.uint64(j * self.bits)) & np.uint64(mask)
            out[:, j] = field
        out = out.reshape(-1, len(a))[:len(row_sums)]
        kind = object if self.wide else np.int64
        own, other = row_sums.astype(kind), a.sum(axis=1).astype(kind)
        out = out - self.bias * own[:, None] - (self.bias * other + self.n * self.bias**2)[None, :]
        if self.wide:
            if out.size and max(abs(out.min()), abs(out.max())) >= LARGEST_SCORE:
                raise OverflowError("a score is too large")
            out = out.astype(np.int64)
        return out


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, absent, label, q) of the rows that take part; the label moved on where vec_id is divisible by 7."""
    x = F.col("x")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    seventh = F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False))
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                       F.col(vector).cast("array<double>").alias("x"))
        .where(F.col("label").isNotNull() & x.isNotNull() & finite)
        .select(F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("absent"),
                F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
                F.transform("x", lambda v: F.floor(v * SCALE)).alias("q"))
    )


def _matrix(q: pd.Series, n: int) -> np.ndarray:
    """Rows of equal length: zeros follow shorter vectors."""
    out = np.zeros((len(q), n), np.int64)
    sizes = np.fromiter(map(len, q), np.int64, len(q))
    if len(q) and sizes.min() == n:
        return np.stack(q.to_numpy()).astype(np.int64)
    for i, v in enumerate(q):
        out[i, :len(v)] = v
    return out


def _first(keys: list[np.ndarray], order: list[np.ndarray], k: int) -> np.ndarray:
    """Positions of the first k per key, in the given order."""
    at = np.lexsort((*order[::-1], *keys[::-1]))
    if not len(at):
        return at
    new = np.zeros(len(at), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[at][1:] != key[at][:-1]
    first = np.flatnonzero(new)
    return at[np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)])) < k]


def _tops(scores: np.ndarray, valid: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every column's k best valid scores that reach ``least``; of ties the earlier rows."""
    shown = np.where(valid & (scores >= least[None, :]), scores, NONE)
    if len(shown) > k:
        kth = np.partition(shown, len(shown) - k, axis=0)[len(shown) - k]
        shown = np.where(shown >= kth[None, :], shown, NONE)
    row, column = np.nonzero(shown > NONE)
    at = _first([column], [-scores[row, column], row], k)
    return row[at], column[at]


class _Kept:
    """The first k of each key so far: (key, score, row number, vec_id, absent)."""

    def __init__(self, keys: int, k: int) -> None:
        self.k, self.least, self.rows = k, np.full(keys, NONE + 1), [np.zeros(0, np.int64)] * 4 + [np.zeros(0, bool)]

    def add(self, new: list[tuple], rows: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        """``new`` has (keys, scores, places in the block)."""
        key, score, at = (np.concatenate(x) for x in zip(*new))
        self.rows = [np.r_[a, b] for a, b in zip(self.rows, (key, score, rows[at], ids[at], absent[at]))]
        at = _first([self.rows[0]], [-self.rows[1], self.rows[4], self.rows[3], self.rows[2]], self.k)
        self.rows = [r[at] for r in self.rows]
        n = np.bincount(self.rows[0], minlength=len(self.least))
        low = np.full(len(self.least), np.iinfo(np.int64).max)
        np.minimum.at(low, self.rows[0], self.rows[1])
        self.least = np.where(n >= self.k, low, NONE + 1)  # an equal score may still come first by its id


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k per key of what the tasks kept; in two steps, so that no task gets all of a key's."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")]
    out = found.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(16)))
    for by in ([*keys, "part"], keys):
        out = out.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return out.drop("part")


PACKED = "n long, ids binary, absent binary, rows binary, labels binary, sums binary, words binary"


def pack_rows(rows: DataFrame, layout: Packing, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, label, q, row) in packed blocks, stored; a block's rows lie in the order of ties."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for lo in range(0, len(pdf), block_rows):
                own = pdf.iloc[lo:lo + block_rows]
                own = own.sort_values(["absent", "vec_id", "row"])
                q = _matrix(own["q"], layout.n)
                words = layout.pack(q)
                data = (b"\n".join(b"%x" % w for w in words.ravel().tolist()) if layout.wide else words.tobytes())
                yield pd.DataFrame({
                    "n": [len(own)], "ids": [own["vec_id"].to_numpy(np.int64).tobytes()],
                    "absent": [own["absent"].to_numpy(bool).tobytes()], "rows": [own["row"].to_numpy(np.int64).tobytes()],
                    "labels": [own["label"].to_numpy(np.int64).tobytes()], "sums": [q.sum(axis=1).tobytes()], "words": [data]})

    return scratch_table(rows.mapInPandas(filled(run), PACKED), "packed")


def _unpacked(frames: Iterator[pd.DataFrame], layout: Packing) -> Iterator[tuple]:
    for pdf in frames:
        for b in pdf.itertuples():
            of = lambda data, kind=np.int64: np.frombuffer(data, kind)
            if not layout.n:
                words = np.zeros(0, np.uint64)
            elif layout.wide:
                words = np.array([int(w, 16) for w in b.words.split(b"\n")], object)
            else:
                words = np.frombuffer(b.words, np.uint64)
            words = words.reshape(-(-b.n // layout.fields), layout.n)
            yield words, of(b.sums), of(b.labels), of(b.ids), of(b.absent, bool), of(b.rows)


def _anchor_blocks(anchors: DataFrame, n: int, size: int) -> Iterator[tuple]:
    """A bounded number of anchors at a time: (row numbers, vec_ids, labels, components)."""
    held = []
    for r in anchors.select("row", "vec_id", "label", "q").toLocalIterator(prefetchPartitions=True):
        held.append(r)
        if len(held) == size:
            yield _anchor_arrays(held, n)
            held = []
    if held:
        yield _anchor_arrays(held, n)


def _anchor_arrays(held: list, n: int) -> tuple:
    of = lambda name: np.array([r[name] for r in held], np.int64)
    return of("row"), of("vec_id"), of("label"), _matrix(pd.Series([r["q"] for r in held]), n)


FOUND = "anchor long, slot int, score long, row long, vec_id long"


def _positives(packed: DataFrame, layout: Packing, block: tuple, k: int) -> DataFrame:
    """(anchor, score, row, vec_id, rank): each anchor's k best other rows of its label."""
    sent = packed.sparkSession.sparkContext.broadcast(block)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_row, _, own_label, a = sent.value
        kept = _Kept(len(a), k)
        for words, sums, labels, ids, absent, rows in _unpacked(frames, layout):
            new = []
            for lo in range(0, len(a), TILE):
                part = slice(lo, lo + TILE)
                s = layout.scores(words, sums, a[part])
                valid = (labels[:, None] == own_label[part][None, :]) & (rows[:, None] != own_row[part][None, :])
                r, c = _tops(s, valid, k, kept.least[part])
                new.append((c + lo, s[r, c], r))
            kept.add(new, rows, ids, absent)
        key, score, row, vec_id, absent = kept.rows
        yield pd.DataFrame({"anchor": key, "slot": 0, "score": score, "row": row,
                            "vec_id": pd.Series(vec_id).astype("Int64").mask(absent)})

    return _merged(packed.mapInPandas(filled(run), FOUND), ["anchor"], k)


def _negatives(packed: DataFrame, layout: Packing, block: tuple, score: np.ndarray, k: int) -> DataFrame:
    """(anchor, slot, score, row, vec_id, rank): the k best rows of other labels within the limits that each
    positive's score sets; ``score`` is (anchors, positives), NONE where there is no positive."""
    sent = packed.sparkSession.sparkContext.broadcast((block, score))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (_, _, own_label, a), score = sent.value
        slots = score.shape[1]
        there = score > NONE
        low, high = np.where(there, -(-LOW * score // 100), 1), np.where(there, HIGH * score // 100, 0)
        kept = _Kept(len(a) * slots, k)
        for words, sums, labels, ids, absent, rows in _unpacked(frames, layout):
            new = []
            for lo in range(0, len(a), TILE):
                part = slice(lo, lo + TILE)
                s = layout.scores(words, sums, a[part])
                other = labels[:, None] != own_label[part][None, :]
                for j in range(slots):
                    numbers = np.arange(lo, lo + s.shape[1]) * slots + j
                    least = np.maximum(kept.least[numbers], low[part, j])
                    r, c = _tops(s, other & (s <= high[part, j][None, :]), k, least)
                    new.append((numbers[c], s[r, c], r))
            kept.add(new, rows, ids, absent)
        key, found, row, vec_id, absent = kept.rows
        yield pd.DataFrame({"anchor": key // slots, "slot": key % slots, "score": found, "row": row,
                            "vec_id": pd.Series(vec_id).astype("Int64").mask(absent)})

    return _merged(packed.mapInPandas(filled(run), FOUND), ["anchor", "slot"], k)


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
         vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         block_rows: int = BLOCK_ROWS, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors are the rows
    whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    # Row numbers are fixed by writing the rows.
    rows = scratch_table(quantised(vectors, vec_id, vector, label)
                         .withColumn("row", F.monotonically_increasing_id()), "quantised")
    size = rows.agg(F.max(F.size("q")), F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    if size[0] is None:
        return empty
    low, high = min(size[1] or 0, 0), max(size[2] or 0, 0)
    if max(-low, high) >= LARGEST:
        raise OverflowError("a component is too large")
    layout = Packing(size[0], low, high)
    packed = pack_rows(rows, layout, block_rows)
    out = None
    for block in _anchor_blocks(rows.where(~F.col("absent") & (F.pmod("vec_id", F.lit(every)) == 0)), layout.n, anchors):
        best = _positives(packed, layout, block, positives).collect()  # anchors x positives short rows at most
        score = np.full((len(block[0]), positives), NONE)
        for r in best:
            score[r["anchor"], r["rank"] - 1] = r["score"]
        pairs = spark.createDataFrame(
            [(r["anchor"], r["rank"] - 1, int(block[1][r["anchor"]]), r["vec_id"], r["score"]) for r in best],
            "anchor long, slot int, anchor_id long, positive_id long, positive_score long")
        found = _negatives(packed, layout, block, score, negatives)
        found = found.join(F.broadcast(pairs), ["anchor", "slot"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        out = found if out is None else out.unionByName(found)
    return empty if out is None else out
