"""N-gram Jaccard join through prefix trees.

A text's set holds its distinct n-word shingles by hash. How many different sets hold a
shingle is counted in hash buckets: blocks of texts send each bucket its shingles, packed, and the bucket sends back
only those that two or more sets share. The others (most of all shingles) never meet again: they
count in a set's size, not in an intersection. All shared shingles are ordered alike everywhere,
by the magnitude of their count and then by hash.

Two sets that link share one of the rarest ``n - ceil(t n) + 1`` shingles of either. Sets that have
enough shingles of their own for that many link with nothing and are gone. The others form groups of sets reachable
over such shingles; of each shingle only the edges to its least set are kept, so a frequent one
makes no pairs. A group's sets, the most frequent shingles first, are stored in a trie with joined paths. A set walks the
trie depth first; all sets below a node share the overlap counted so far. A
subtree is left out when the lengths that remain on both sides cannot reach the threshold, or when all of its sets are
already in the walking set's component. A group beyond ``cell_tokens`` is cut into parts, and every two parts
meet in a task of their own, so that no task holds more than two parts.

Equal sets are one set throughout; the links found span each component.

Defined results: null texts and texts without words have an empty set, linked with nothing, and are
components of their own; texts of fewer words than a shingle are one shingle, which equals only such a text; repeated rows
share a component; a null doc_id never names a component unless it has no other; an empty table gives an empty result;
other columns are ignored. Shingles are compared by 40 bits of their hash and the number of their bucket, sets by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import arrow_rows, components, filled, runs, scratch_table, text_bytes

SHINGLE = 4
PERCENT = 85  # of the union that the intersection must reach
BUCKET_TOKENS = 1 << 21  # shingles that a bucket counts, on average
BLOCK_TOKENS = 1 << 20  # shingles that a task packs at once
CELL_TOKENS = 1 << 21  # shared shingles of a trie
VALUE_BITS, BUCKET_BITS = 40, 20
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingle_set(data: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending."""
    words = data.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(shingle, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for i in range(width):
        h = (h ^ w[i:len(w) - width + 1 + i]) * _ODD
        h ^= h >> np.uint64(32)
    h *= _MIX
    return np.unique(h ^ (h >> np.uint64(29)))


def set_id(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64))


def needed(n: int, percent: int = PERCENT) -> int:
    """How many of its rarest shingles a set must look at."""
    return n + (-percent * n // 100) + 1


def linked(common: int, nx: int, ny: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (nx + ny - common)


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 1)


def members(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """(doc_id, absent, n, sid) of every row, stored."""
    arrow_rows(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            sets = [shingle_set(data, shingle) for data in pdf["data"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "absent": pdf["absent"], "n": [len(s) for s in sets],
                                "sid": [set_id(s) for s in sets]})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                       F.col("doc_id").isNull().alias("absent"), text_bytes(text).alias("data"))
    return scratch_table(rows.mapInPandas(filled(run), "doc_id long, absent boolean, n long, sid long"), "members")


def _asked(docs: DataFrame, buckets: int, shingle: int, text: str) -> DataFrame:
    """(bucket, n_sets, n_tokens, data): a block's shingles of one bucket, by set."""
    names = ["bucket", "n_sets", "n_tokens", "data"]

    def flush(held: dict[int, np.ndarray]) -> pd.DataFrame:
        sizes = np.fromiter(map(len, held.values()), np.int64, len(held))
        tokens = np.concatenate(list(held.values()))
        owner = np.repeat(np.arange(len(held)), sizes)
        bucket = ((tokens >> np.uint64(VALUE_BITS)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        sids = np.fromiter(held, np.int64, len(held))
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rows = []
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]):
            first = np.flatnonzero(np.r_[True, owner[lo + 1:hi] != owner[lo:hi - 1]])
            count = np.diff(np.r_[first, hi - lo]).astype(np.int32)
            value = tokens[lo:hi].view(np.uint8).reshape(-1, 8)[:, :VALUE_BITS // 8]
            rows.append((int(bucket[lo]), len(first), hi - lo, _pack(sids[owner[lo:hi][first]], count, value)))
        return pd.DataFrame(rows, columns=names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = {}, 0
        for pdf in frames:
            for data in pdf["data"]:
                tokens = shingle_set(data, shingle)
                if len(tokens) and (sid := set_id(tokens)) not in held:
                    held[sid] = tokens
                    size += len(tokens)
                if size >= BLOCK_TOKENS:
                    yield flush(held)
                    held, size = {}, 0
        if held:
            yield flush(held)

    return docs.select(text_bytes(text).alias("data")).mapInPandas(
        filled(run), "bucket int, n_sets int, n_tokens int, data binary")


def _pairs(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(values, set ids) of a bucket's rows."""
    values, owners = [], []
    for n, m, data in zip(pdf["n_sets"], pdf["n_tokens"], pdf["data"]):
        raw = zstandard.decompress(data)
        value = np.zeros((m, 8), np.uint8)
        value[:, :VALUE_BITS // 8] = np.frombuffer(raw, np.uint8, offset=12 * n).reshape(m, VALUE_BITS // 8)
        values.append(value.view(np.uint64)[:, 0])
        owners.append(np.repeat(np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int32, n, 8 * n)))
    return np.concatenate(values), np.concatenate(owners)


def shared_sets(docs: DataFrame, sizes: DataFrame, buckets: int, shingle: int = SHINGLE, percent: int = PERCENT,
                text: str = "text") -> DataFrame:
    """(sid, n, size, tokens, prefix) of every set that may link: its shared shingles in the common
    order, rarest first, and those that it must look at. ``sizes`` has (sid, n) of all sets."""

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        value, owner = _pairs(pdf)
        order = np.lexsort((owner, value))
        value, owner = value[order], owner[order]
        new = np.r_[True, value[1:] != value[:-1]]
        fresh = new | np.r_[True, owner[1:] != owner[:-1]]  # equal sets of other blocks are no second holder
        value, owner, new = value[fresh], owner[fresh], new[fresh]
        starts = np.flatnonzero(new)
        df = np.diff(np.r_[starts, len(value)])
        magnitude = np.minimum(15, np.floor(np.log2(df))).astype(np.uint64)
        keep = np.repeat(df > 1, df)
        bucket = np.uint64(pdf["bucket"].iloc[0])
        token = (np.repeat(magnitude, df) << np.uint64(60) | bucket << np.uint64(VALUE_BITS) | value)[keep]
        owner = owner[keep]
        part = owner % buckets
        order = np.argsort(part, kind="stable")
        part, owner, token = part[order], owner[order], token[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
        rows = [(int(part[lo]), hi - lo, _pack(owner[lo:hi], token[lo:hi]))
                for lo, hi in zip(starts, [*starts[1:], len(part)])]
        return pd.DataFrame(rows, columns=["part", "m", "data"], dtype=object)

    def gather(answers: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(answers):
            raw = [zstandard.decompress(d) for d in answers["data"]]
            owner = np.concatenate([np.frombuffer(r, np.int64, m) for r, m in zip(raw, answers["m"])])
            token = np.concatenate([np.frombuffer(r, np.uint64, m, 8 * m) for r, m in zip(raw, answers["m"])])
            order = np.lexsort((token, owner))
            owner, token = owner[order], token[order]
            size_of = dict(zip(own["sid"], own["n"]))
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(owner)]):
                sid, tokens = int(owner[lo]), token[lo:hi]
                n = int(size_of[sid])
                look = needed(n, percent) - (n - len(tokens))
                if look > 0:
                    rows.append((sid, n, len(tokens), tokens.tobytes(), tokens[:look].view(np.int64).tolist()))
        return pd.DataFrame(rows, columns=["sid", "n", "size", "tokens", "prefix"], dtype=object)

    answers = _asked(docs, buckets, shingle, text).groupBy("bucket").applyInPandas(
        answer, "part long, m int, data binary")
    parted = sizes.withColumn("part", F.pmod("sid", F.lit(buckets)))
    return scratch_table(answers.groupBy("part").cogroup(parted.groupBy("part")).applyInPandas(
        gather, "sid long, n long, size long, tokens binary, prefix array<long>"), "sets")


def groups(sets: DataFrame) -> DataFrame:
    """(sid, group) of the sets that share a shingle of their prefixes with another set."""
    prefix = sets.select("sid", F.explode("prefix").alias("token"))
    least = prefix.groupBy("token").agg(F.min("sid").alias("first"), F.max("sid").alias("last")).where("first < last")
    edges = prefix.join(least, "token").where("sid > first").select(F.col("sid").alias("a"), F.col("first").alias("b"))
    return components(edges.distinct()).withColumnsRenamed({"node": "sid", "root": "group"})


class _Node:
    """A joined path: its shingles, what hangs below, and bounds over the sets below."""

    __slots__ = ("path", "below", "ends", "least", "most", "of")

    def __init__(self, path: np.ndarray) -> None:
        self.path, self.below, self.ends = path, {}, []
        self.least, self.most, self.of = 1 << 62, 0, None  # least size, most shared shingles, component (-1: several)


class PrefixTree:
    """Sets as ascending numbers in the common order, the most frequent shingle first."""

    def __init__(self, universe: int, sizes: list[int], percent: int = PERCENT) -> None:
        self.root, self.sizes, self.percent = _Node(np.zeros(0, np.int32)), sizes, percent
        self.mark = np.zeros(universe, np.uint8)
        self.parent = list(range(len(sizes)))
        self.visited = 0

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def add(self, i: int, x: np.ndarray) -> None:
        node, pos, n, own = self.root, 0, self.sizes[i], self.find(i)
        while True:
            node.least, node.most = min(node.least, n), max(node.most, len(x))
            if node.of is None:
                node.of = i
            elif node.of >= 0 and self.find(node.of) != own:
                node.of = -1
            if pos == len(x):
                node.ends.append(i)
                return
            child = node.below.get(int(x[pos]))
            if child is None:
                child = node.below[int(x[pos])] = _Node(x[pos:])
                pos = len(x)
            else:
                rest = x[pos:pos + len(child.path)]
                differ = np.flatnonzero(child.path[:len(rest)] != rest)
                same = int(differ[0]) if len(differ) else len(rest)
                if same < len(child.path):  # cut the path in two
                    upper = _Node(child.path[:same])
                    upper.least, upper.most, upper.of = child.least, child.most, child.of
                    child.path = child.path[same:]
                    upper.below[int(child.path[0])] = child
                    child = node.below[int(upper.path[0])] = upper
                pos += same
            node = child

    def walk(self, i: int, x: np.ndarray) -> list[int]:
        """Links set i with sets of the tree until its component holds all that it links with; returns their numbers."""
        mark, sizes, percent = self.mark, self.sizes, self.percent
        mark[x] = 1
        nx, sx, found = sizes[i], len(x), []
        todo = [(self.root, 0, 0, False)]
        while todo:
            node, depth, common, over = todo.pop()
            if over:  # all below was seen: note whether it is one component now
                roots = {self.find(e) for e in node.ends}
                for child in node.below.values():
                    if len(roots) > 1:
                        break
                    roots.add(self.find(child.of) if child.of >= 0 else -1)
                if len(roots) == 1:
                    node.of = roots.pop()
                continue
            if node.of is None or node.of >= 0 and self.find(node.of) == self.find(i):
                continue
            self.visited += 1
            rest = sx
            if len(node.path):
                depth += len(node.path)
                common += int(np.count_nonzero(mark[node.path]))
                rest = sx - int(x.searchsorted(node.path[-1], side="right"))
            more = min(rest, node.most - depth)
            # at best, ``more`` shingles to come are common; a set below has at least so many and ``least`` in all
            if not linked(common + more, nx, max(node.least, depth + more), percent):
                continue
            for e in node.ends:
                if self.find(e) != self.find(i) and linked(common, nx, sizes[e], percent):
                    self.parent[self.find(e)] = self.find(i)
                    found.append(e)
            if node.of == -1:
                todo.append((node, 0, 0, True))
            todo.extend((child, depth, common, False) for child in node.below.values())
        mark[x] = 0
        return found


def _links(sids: list[int], sizes: list[int], tokens: list[np.ndarray], in_tree: list[bool], alone: bool,
           percent: int) -> list[tuple[int, int]]:
    """Spanning links of one cell; ``alone``: the cell is one part, whose sets meet each other."""
    all_tokens, number = np.unique(np.concatenate(tokens), return_inverse=True)
    number = (len(all_tokens) - 1 - number).astype(np.int32)  # the most frequent first
    at = np.r_[0, np.cumsum([len(t) for t in tokens])]
    sets = [number[lo:hi][::-1] for lo, hi in zip(at[:-1], at[1:])]
    tree, out = PrefixTree(len(all_tokens), sizes, percent), []
    order = sorted(range(len(sets)), key=lambda i: (sizes[i], sids[i]))
    if not alone:
        for i in order:
            if in_tree[i]:
                tree.add(i, sets[i])
        order = [i for i in order if not in_tree[i]]
    for i in order:
        out += [(sids[i], sids[e]) for e in tree.walk(i, sets[i])]
        if alone:
            tree.add(i, sets[i])
    return out


def link(sets: DataFrame, percent: int = PERCENT, cell_tokens: int = CELL_TOKENS) -> DataFrame:
    """Edges (a, b) of set ids that connect all sets within the threshold."""
    grouped = scratch_table(groups(sets), "groups")
    size = sets.select("sid", "size").join(grouped, "sid").groupBy("group").agg(F.sum("size").alias("tokens"))
    parts = size.select("group", F.ceil(F.col("tokens") / F.lit(cell_tokens)).cast("int").alias("parts"))
    cells = (
        grouped.join(parts, "group")
        .withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("sid", "group", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                (F.col("part") <= F.col("other")).alias("in_tree"))
    )
    cell = ["group", "lo", "hi"]

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in runs(frames, cell):
            ids = pdf[cell].to_numpy()
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
            sid, n, tokens, in_tree = (pdf[c].tolist() for c in ("sid", "n", "tokens", "in_tree"))
            out = []
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(pdf)]):
                if hi - lo > 1:
                    out += _links(sid[lo:hi], n[lo:hi], [np.frombuffer(t, np.uint64) for t in tokens[lo:hi]],
                                  in_tree[lo:hi], ids[lo, 1] == ids[lo, 2], percent)
            yield pd.DataFrame(out, columns=["a", "b"])

    return (sets.select("sid", "n", "tokens").join(cells, "sid")
            .repartition(*cell).sortWithinPartitions(*cell)
            .mapInPandas(filled(search), "a long, b long").distinct())


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bucket_tokens: int = BUCKET_TOKENS,
         cell_tokens: int = CELL_TOKENS, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = members(docs, shingle, text)
    own_id = F.when(F.col("absent"), F.lit(None)).otherwise(F.col("doc_id")).cast("long")
    rows = rows.select(own_id.alias("doc_id"), "n", "sid")
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = min(1 << BUCKET_BITS, max(1, -(-total // bucket_tokens)))
    least = rows.where("n > 0").groupBy("sid", "n").agg(F.min("doc_id").alias("least"))
    sets = shared_sets(docs, least.select("sid", "n"), buckets, shingle, percent, text)
    found = components(link(sets, percent, cell_tokens))
    member = scratch_table(least.join(found.withColumnRenamed("node", "sid"), "sid", "left")
                           .select("sid", "least", F.coalesce("root", "sid").alias("root")), "classes")
    first = member.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = member.join(first, "root").select("sid", "component_id")
    some = rows.where("n > 0").join(by_set, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)
