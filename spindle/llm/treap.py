"""Ranked lexical search through K2-treaps over the term-document grid.

The documents of a task are cut into blocks. A block is a square grid with its
terms as rows, ``1 << ROW_GAP`` apart, and its documents in ascending doc_id as
columns; a point holds the impact of a term in a document. A compressed quadtree
over the grid stores the greatest impact of every cell, as the difference to the cell above;
a cell with a single point is a leaf, whatever its size. Rows lie apart so
that cells of few columns belong to one row, which makes their maxima sharp.

A search follows the row paths of all terms of an item jointly, over ranges of
documents: a range's bound is the sum of weight times cell maximum over the
item's paths. The ranges with the greatest bounds are opened first (``WIDTH`` of each item at
once, all items of a block together, so that the steps are array operations), halves whose
bound is under the item's current k-th score are cut, and a range of one column is a document with
its exact score. The k-th score is carried from block to block of a task.

The index does not depend on the items: an impact needs the term's and the document's counts and the
two totals over all documents, and the weights enter at the search.

Defined results: null texts have no terms and are never found; an item without
terms finds nothing; items with equal ids are answered one by one; repeated
documents are ranked each by itself; equal scores rank by ascending doc_id, null ids last; an
empty table or no items give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spindle.llm.common import arrow_rows, filled, scratch_table, text_bytes

ROW_GAP = 6
BLOCK_TERMS = 1 << 18  # bound of a block's terms with repeats, beyond its last document
WIDTH = 64
ITEM_BYTES = 8 << 20  # items that one search job takes at most: bytes of text, and number
ITEMS = 4096
K = 10

POINTS = 1 << 20  # points that items searched at once may have in a block

#: An index row has megabytes. Spark holds a row group's values of a column at once, so each row gets a group of its
#: own; dictionaries and statistics would keep copies of the values until a file ends.
STORED = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false",
          "parquet.column.statistics.enabled": "false"}

#: Bytes of a term stay, A-Z become small, others become blanks.
_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(data: bytes) -> list[bytes]:
    """The text's terms, with repeats."""
    return data.translate(_TABLE).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n: int, docs: int, length: int) -> int:
    """m of a document with n terms, among ``docs`` documents with ``length`` terms."""
    return 100 - 90 + (90 * n * docs) // length


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """The 32 bits of x at the even places of 64."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


_COUNT = np.array([bin(i).count("1") for i in range(16)], np.int8)


@dataclass
class Treap:
    """The cells in breadth-first order. ``mask`` has a bit per quarter (2 * row bit + column bit) that holds
    points, and is 0 for leaves; ``drop`` is the maximum above less the own one; ``leaf`` has the leaves' points."""

    height: int
    mask: np.ndarray
    drop: np.ndarray
    leaf_row: np.ndarray
    leaf_col: np.ndarray

    @staticmethod
    def build(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> Treap:
        """From points with distinct (row, col); rows and columns count from 0."""
        side = max((int(row.max(initial=0)) + 1) << ROW_GAP, int(col.max(initial=0)) + 1)
        height = max(1, (side - 1).bit_length())
        code = (_spread(row.astype(np.int64) << ROW_GAP) << np.uint64(1)) | _spread(col)
        order = np.argsort(code, kind="stable")
        code, row, col, value = code[order], row[order].astype(np.int32), col[order].astype(np.int32), value[order]
        masks, drops, rows, cols = [], [], [], []
        starts, above = np.zeros(min(1, len(code)), np.int64), np.zeros(min(1, len(code)), np.int64)
        for level in range(height + 1):
            if not len(code):
                break
            # the cells of this level: runs of points, each with its parent's maximum
            ends = np.r_[starts[1:], len(code)]
            own = np.maximum.reduceat(value, starts)
            drops.append((own if level == 0 else above - own).astype(np.int32))
            alone = (ends - starts == 1) | (level == height)
            rows.append(row[starts[alone]])
            cols.append(col[starts[alone]])
            mask = np.zeros(len(starts), np.uint8)
            if level < height:
                size = ends - starts
                keep = np.repeat(~alone, size)
                cell = np.repeat(np.cumsum(~alone) - 1, size)[keep]
                code, row, col, value = code[keep], row[keep], col[keep], value[keep]
                quarter = ((code >> np.uint64(2 * (height - 1 - level))) & np.uint64(3)).astype(np.int64)
                if len(code):
                    starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (quarter[1:] != quarter[:-1])])
                    mask[~alone] = np.bincount(cell[starts], weights=1 << quarter[starts], minlength=int((~alone).sum()))
                    above = own[~alone][cell[starts]]
            masks.append(mask)
            if level == height:
                break
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return Treap(height, join(masks, np.uint8), join(drops, np.int32), join(rows, np.int32), join(cols, np.int32))

    def unfold(self) -> None:
        """What the search reads: first child, maximum, and number among the leaves, of every cell."""
        n = _COUNT[self.mask]
        self.child = np.cumsum(n, dtype=np.int32) - n + 1
        self.leaf_no = np.cumsum(self.mask == 0, dtype=np.int32) - (self.mask == 0)
        self.max = np.zeros(len(self.mask), np.int32)
        lo, hi = 0, min(1, len(self.mask))
        if hi:
            self.max[0] = self.drop[0]
        while lo < hi:  # a level at a time
            to = hi + int(n[lo:hi].sum(dtype=np.int64))
            self.max[hi:to] = np.repeat(self.max[lo:hi], n[lo:hi]) - self.drop[hi:to]
            lo, hi = hi, to

    def step(self, node: np.ndarray, row: np.ndarray, level: np.ndarray, side: int, start: np.ndarray) -> np.ndarray:
        """The cell below ``node`` on the row's path and in the half ``side`` of its columns, -1 where it holds no point."""
        shift = self.height - 1 - level
        mask = self.mask[node]
        leaf = mask == 0
        bit = ((((row << ROW_GAP) >> shift) & 1) << 1) + side
        there = (mask >> bit) & 1
        down = self.child[node] + _COUNT[mask & ((1 << bit) - 1)]
        at = self.leaf_no[node] * leaf
        begin = start + (side << shift)
        inside = (self.leaf_row[at] == row) & (self.leaf_col[at] >= begin) & (self.leaf_col[at] < begin + (1 << shift))
        return np.where(leaf, np.where(inside, node, -1), np.where(there == 1, down, -1))


def best(keys: np.ndarray, order: tuple, k: int) -> np.ndarray:
    """Positions of the first k of each key, in the order of the arrays in ``order`` (most significant first)."""
    at = np.lexsort((*order[::-1], keys))
    sorted_keys = keys[at]
    first = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(at) else np.zeros(0, np.int64)
    rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    return at[rank < k]


class Search:
    """The running result of many items over many blocks."""

    def __init__(self, k: int, width: int = WIDTH) -> None:
        self.k, self.width, self.opened = k, width, 0
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.doc, self.no_id = np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self, items: int) -> np.ndarray:
        """The score that an item's next find must reach."""
        out = np.ones(items, np.int64)
        n = np.bincount(self.item, minlength=items)
        low = np.full(items, np.iinfo(np.int64).max)
        np.minimum.at(low, self.item, self.score)
        return np.where(n >= self.k, low, out)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        for name, new in (("item", item), ("score", score), ("doc", doc), ("no_id", no_id)):
            setattr(self, name, np.r_[getattr(self, name), new])
        at = best(self.item, (-self.score, self.no_id, self.doc), self.k)
        self.item, self.score, self.doc, self.no_id = self.item[at], self.score[at], self.doc[at], self.no_id[at]

    def run(self, treap: Treap, items: int, item: np.ndarray, row: np.ndarray, w: np.ndarray,
            doc: np.ndarray, no_id: np.ndarray) -> None:
        """Descend for all items at once; (item, row, w) are the terms that the block has, sorted by item."""
        if not len(item) or not len(treap.mask):
            return
        least = self.least(items)
        # an open range: its item, level, first column and bound; its paths lie together in (owner, node, row, w)
        own, first = np.unique(item, return_index=True)
        level, start = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        size = np.diff(np.r_[first, len(item)])
        bound = np.add.reduceat(w * treap.max[0], first)
        node = np.zeros(len(item), np.int64)
        while True:
            good = bound >= least[own]
            if not good.all():
                paths = np.repeat(good, size)
                own, level, start, bound, size = own[good], level[good], start[good], bound[good], size[good]
                node, row, w = node[paths], row[paths], w[paths]
            if not len(own):
                return
            take = np.zeros(len(own), bool)
            take[best(own, (-bound, start), self.width)] = True
            self.opened += int(take.sum())
            paths = np.repeat(take, size)
            o, lv, st, sz = own[take], level[take], start[take], size[take]
            n, r, ww = node[paths], row[paths], w[paths]
            at = np.repeat(np.arange(len(o)), sz)
            rest = (own[~take], level[~take], start[~take], bound[~take], size[~take], node[~paths], row[~paths], w[~paths])
            made = [rest]
            for side in (0, 1):
                child = treap.step(n, r, lv[at], side, st[at])
                has = child >= 0
                if not has.any():
                    continue
                count = np.bincount(at[has], minlength=len(o))
                kept = count > 0
                count, below = count[kept], lv[kept] + 1
                score = np.add.reduceat(ww[has] * treap.max[child[has]], np.cumsum(count) - count)
                made.append((o[kept], below, st[kept] + (side << (treap.height - below)), score, count,
                             child[has], r[has], ww[has]))
            own, level, start, bound, size, node, row, w = (np.concatenate(x) for x in zip(*made))
            done = level == treap.height
            if done.any():
                self.add(own[done], bound[done], doc[start[done]], no_id[start[done]])
                least = self.least(items)
                paths = np.repeat(~done, size)
                own, level, start, bound, size = own[~done], level[~done], start[~done], bound[~done], size[~done]
                node, row, w = node[paths], row[paths], w[paths]

    def run_parts(self, treap: Treap, items: int, item: np.ndarray, row: np.ndarray, w: np.ndarray,
                  doc: np.ndarray, no_id: np.ndarray, df: np.ndarray, most: int = POINTS) -> None:
        """``run`` for some items after others; ``df`` has the points of each row. A cell of up to ``1 << ROW_GAP`` columns
        belongs to one row, so a term has no more open paths than points and such ranges of columns: items with ``most``
        of them in all, or a single one, are searched at once."""
        paths = np.bincount(item, weights=df[row] + (len(doc) >> ROW_GAP) + 1, minlength=items)
        ends, bounds = np.cumsum(paths), [0]
        while bounds[-1] < items:
            lo = bounds[-1]
            bounds.append(max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right"))))
        found = []
        for lo, hi in zip(bounds, bounds[1:]):
            held, own = (slice(*np.searchsorted(x, (lo, hi))) for x in (self.item, item))
            part = Search(self.k, self.width)
            part.item, part.score, part.doc, part.no_id = self.item[held] - lo, self.score[held], self.doc[held], self.no_id[held]
            part.run(treap, hi - lo, item[own] - lo, row[own], w[own], doc, no_id)
            self.opened += part.opened
            found.append((part.item + lo, part.score, part.doc, part.no_id))
        if found:
            self.item, self.score, self.doc, self.no_id = map(np.concatenate, zip(*found))


def totals(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(documents with a term, their terms with repeats) over the whole table."""
    arrow_rows(docs.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = length = 0
        for pdf in frames:
            for data in pdf["data"]:
                size = len(terms(data))
                n, length = n + (size > 0), length + size
        yield pd.DataFrame({"n": [n], "length": [length]})

    row = (docs.select(text_bytes(text).alias("data")).mapInPandas(count, "n long, length long")
           .agg(F.sum("n"), F.sum("length")).first())
    return row[0] or 0, row[1] or 0


INDEX = ("docs long, doc_ids binary, no_id binary, words binary, df binary, height int, mask binary, drop binary, "
         "leaf_row binary, leaf_col binary")


class _Numbers(dict):
    """Terms to numbers, in the order of their first use."""

    def __missing__(self, term: bytes) -> int:
        self[term] = len(self)
        return self[term]


def _block(held: list[tuple], names: _Numbers, docs: int, length: int) -> dict:
    """One index row from (doc_id or None, numbers of its terms with repeats)."""
    held.sort(key=lambda d: (d[0] is None, d[0] or 0))
    size = np.array([len(t) for _, t in held], np.int64)
    point, tf = np.unique(np.repeat(np.arange(len(held)) << 32, size) + np.concatenate([t for _, t in held]),
                          return_counts=True)
    term, col = point & 0xFFFFFFFF, point >> 32
    df = np.bincount(term, minlength=len(names))
    dense = np.argsort(-df, kind="stable")  # rows of like density share cells
    row = np.empty(len(names), np.int64)
    row[dense] = np.arange(len(names))
    m = np.array([length_norm(n, docs, length) for n in size.tolist()], np.int64)
    treap = Treap.build(row[term], col, impact(tf, m[col]))
    words = list(names)
    return {
        "docs": len(held), "doc_ids": np.array([d[0] or 0 for d in held], np.int64).tobytes(),
        "no_id": np.array([d[0] is None for d in held], np.uint8).tobytes(),
        "words": b"\n".join([words[i] for i in dense.tolist()]), "df": df[dense].astype(np.int32).tobytes(),
        "height": treap.height, "mask": treap.mask.tobytes(), "drop": treap.drop.tobytes(),
        "leaf_row": treap.leaf_row.tobytes(), "leaf_col": treap.leaf_col.tobytes(),
    }


def build(docs: DataFrame, text: str = "text", block_terms: int = BLOCK_TERMS) -> tuple[DataFrame, int, int]:
    """(index, documents with a term, their terms): one row per block, stored in the shared folder."""
    n, length = totals(docs, text)
    if not n:
        return docs.sparkSession.createDataFrame([], INDEX), 0, 0
    columns = [c.split()[0] for c in INDEX.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, names, size = [], _Numbers(), 0
        for pdf in frames:
            for doc_id, absent, data in zip(pdf["doc_id"], pdf["absent"], pdf["data"]):
                own = terms(data)
                if own:
                    held.append((None if absent else int(doc_id),
                                 np.fromiter(map(names.__getitem__, own), np.int32, len(own))))
                    size += len(own)
                if size >= block_terms:
                    yield pd.DataFrame([_block(held, names, n, length)], columns=columns)
                    held, names, size = [], _Numbers(), 0
        if held:
            yield pd.DataFrame([_block(held, names, n, length)], columns=columns)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                       F.col("doc_id").isNull().alias("absent"), text_bytes(text).alias("data"))
    return scratch_table(rows.mapInPandas(run, INDEX), "k2treap", **STORED), n, length


def _item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Items as (id, bytes), a bounded number and size at a time."""
    held, size = [], 0
    for r in items.select(F.col(item_id).alias("id"), text_bytes(text).alias("data")).toLocalIterator():
        held.append((r["id"], bytes(r["data"])))
        size += len(held[-1][1])
        if size >= ITEM_BYTES or len(held) == ITEMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _answer(spark: SparkSession, index: DataFrame, docs: int, held: list[tuple], kind: str, k: int, width: int) -> DataFrame:
    """The k best documents of one bounded block of items."""
    asked = [list(dict.fromkeys(terms(data))) for _, data in held]
    names = sorted({t for own in asked for t in own})
    number = {t: i for i, t in enumerate(names)}
    shared = spark.sparkContext.broadcast(names)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(shared.value), np.int64)
        for pdf in frames:
            for words, df in zip(pdf["words"], pdf["df"]):
                row_of = {t: i for i, t in enumerate(words.split(b"\n"))}
                n = np.frombuffer(df, np.int32)
                total += [int(n[row_of[t]]) if t in row_of else 0 for t in shared.value]
        at = np.flatnonzero(total)
        yield pd.DataFrame({"term": at, "n": total[at]})

    found = {r["term"]: r["n"] for r in index.select("words", "df").mapInPandas(filled(count), "term long, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).collect()}  # one short row per term of the items at most
    w = [weight(found.get(i, 0), docs) for i in range(len(names))]
    item = np.repeat(np.arange(len(held)), [len(x) for x in asked])
    term = np.fromiter((number[t] for own in asked for t in own), np.int64, len(item))
    sent = spark.sparkContext.broadcast((len(held), item, term, np.array(w, np.int64)))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, item, term, w = sent.value
        result = Search(k, width)
        for pdf in frames:
            for b in pdf.itertuples():
                row_of = {t: i for i, t in enumerate(b.words.split(b"\n"))}
                row = np.array([row_of.get(t, -1) for t in shared.value], np.int64)[term]
                has = (row >= 0) & (w[term] > 0)
                of = lambda data, kind: np.frombuffer(data, kind)
                treap = Treap(b.height, of(b.mask, np.uint8), of(b.drop, np.int32), of(b.leaf_row, np.int32), of(b.leaf_col, np.int32))
                treap.unfold()
                result.run_parts(treap, items, item[has], row[has], w[term][has], of(b.doc_ids, np.int64),
                                 of(b.no_id, np.uint8).astype(bool), of(b.df, np.int32))
        yield pd.DataFrame({"item": result.item, "score": result.score, "opened": result.opened,
                            "doc_id": pd.Series(result.doc).astype("Int64").mask(result.no_id)})

    hits = index.mapInPandas(filled(search), "item long, score long, opened long, doc_id long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Tasks send k rows an item; these meet in groups first, so that no task gets all of an item's.
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(16))
    for keys in (["item", "part"], ["item"]):
        hits = hits.withColumn("part", part) if "part" in keys else hits
        hits = hits.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, h[0]) for i, h in enumerate(held)], f"item long, item_id {kind}")
    return hits.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, item_id: str = "item_id", text: str = "text",
           block_terms: int = BLOCK_TERMS, width: int = WIDTH) -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    index, n, _ = build(docs, text, block_terms)
    out = None
    for held in _item_blocks(items, item_id, text) if n else ():
        found = _answer(spark, index, n, held, kind, k, width)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out
