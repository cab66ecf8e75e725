"""SimHash near-duplicates through BK-trees.

Every distinct fingerprint is cut into ``radius + 2`` bit pieces. Two
fingerprints within the radius agree on at least two whole pieces, so every
pair of pieces is a shard key and no link between shards is lost. In each shard a
BK-tree (children keyed by their integer Hamming distance to the parent) is
searched along the edges that the triangle inequality leaves open. A shard
that grows beyond ``max_tree`` is cut into several trees, and every part is
taken past every tree in a task of its own, so that no task holds more than
two parts however many fingerprints share a shard.

Defined results: null and empty texts have fingerprint zero and link like any
other; repeated rows share a component; a null doc_id never becomes a
component id unless a component has no other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spindle.llm.common import arrow_rows, components, runs, scratch_table, text_bytes

SEED = 42
BITS = 64
MASK = (1 << BITS) - 1


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """Unsigned SimHash of one text: bit set where it is set in over half the shingles' XXH64."""
    words = data.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(g, SEED) for g in grams), dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, out: str = "fp", shingle: int = 3, text: str = "text") -> DataFrame:
    """``df`` plus the signed 64-bit fingerprint of its text column."""
    arrow_rows(df.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(found.view(np.int64))

    return df.withColumn(out, simhash(text_bytes(text)))


class BKTree:
    """Children of a node are keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        node = self.root
        if node is None:
            self.root = (value, {})
            return
        while d := (node[0] ^ value).bit_count():
            if d not in node[1]:
                node[1][d] = (value, {})
                return
            node = node[1][d]

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            at, children = open_nodes.pop()
            d = (at ^ value).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    open_nodes.append(child)
        return found


def _forest(tree_side: list[int], query_side: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links of one cell, thinned to a spanning forest of what they connect."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out, tree = [], BKTree()
    if query_side is not None:
        for v in tree_side:
            tree.add(v)
    for v in tree_side if query_side is None else query_side:
        for hit in tree.within(v, radius):
            a, b = find(v), find(hit)
            if a != b:
                parent[a] = b
                out.append((v, hit))
        if query_side is None:
            tree.add(v)
    return out


def link(fps: DataFrame, radius: int = 3, max_tree: int = 4096) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column fp) within the radius."""
    pieces = radius + 2
    edges_at = [round(i * BITS / pieces) for i in range(pieces + 1)]
    piece = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges_at, edges_at[1:])]
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    masks = [signed(piece[i] | piece[j]) for i, j in combinations(range(pieces), 2)]

    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("shard"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.shard", "k.bits")
    large = (keyed.groupBy("shard", "bits").count().where(F.col("count") > max_tree)
             .select("shard", "bits", F.ceil(F.col("count") / max_tree).cast("int").alias("parts")))
    cells = (
        keyed.join(large, ["shard", "bits"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("shard", "bits", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                (F.col("part") <= F.col("other")).alias("in_tree"), "fp")
    )
    cell = ["shard", "bits", "lo", "hi"]

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in runs(frames, cell):
            ids = pdf[cell].to_numpy()
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(ids)]
            fp, tree = pdf["fp"].to_numpy().view(np.uint64), pdf["in_tree"].to_numpy()
            own = pdf["lo"].to_numpy() == pdf["hi"].to_numpy()
            a, b = [], []
            for lo, hi in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                values, side = fp[lo:hi], tree[lo:hi]
                found = (_forest(values.tolist(), None, radius) if own[lo]
                         else _forest(values[side].tolist(), values[~side].tolist(), radius))
                for x, y in found:
                    a.append(x)
                    b.append(y)
            if a:
                yield pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64),
                                    "b": np.array(b, np.uint64).view(np.int64)})

    return (cells.repartition(*cell).sortWithinPartitions(*cell, "fp")
            .mapInPandas(search, "a long, b long").distinct())


def classes(fps: DataFrame, radius: int = 3, max_tree: int = 4096) -> DataFrame:
    """(fp, root) of every distinct fingerprint; root names its component."""
    found = components(link(fps.select("fp").distinct(), radius, max_tree))
    return (fps.select("fp").distinct()
            .join(found.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, max_tree: int = 4096) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = scratch_table(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle)
                         .select("doc_id", "fp"), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    member = scratch_table(classes(least, radius, max_tree).join(least, "fp"), "classes")
    first = member.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = member.join(first, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, max_tree: int = 4096) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (nulls last), then
    the smallest fingerprint, then the smallest text hash. All columns are returned as they came."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    rows = with_fingerprint(held, "fp", shingle).drop("text")
    ids = scratch_table(rows.select("doc_id", "fp"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")
    least = ids.groupBy("fp").agg(F.min(order).alias("first"))
    member = classes(least, radius, max_tree).join(least, "fp")
    winner = member.groupBy("root").agg(F.min("first").alias("w")).select("w.doc_id", "w.fp")
    same = W.partitionBy("doc_id", "fp").orderBy(F.xxhash64("row.text"))
    left, right = rows.alias("l"), winner.alias("r")
    kept = left.join(right, (F.col("l.fp") == F.col("r.fp")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")),
                     "left_semi")
    return (kept.withColumn("nth", F.row_number().over(same)).where("nth = 1")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
