"""Ranked search, hard negatives and the n-gram join against brute force."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from spindle.llm import packed, prefixtree, treap
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, item string, n long, `row` string, part int, score long, sid long"


def odd_texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["É", "日本", "A-b", "x1"]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 4, 5, 30, 80, 200]))] for _ in range(40)]
    near = []
    for b in base:
        for _ in range(rng.choice([0, 0, 1, 4])):
            c = list(b)
            for _ in range(rng.choice([0, 1, 2, 6])):
                c[rng.randrange(len(c))] = rng.choice(words)
            near.append(c)
    texts = [" ".join(x) for x in base + near]
    long = " ".join(rng.choice(words) for _ in range(20_000))
    texts += [None, "", " \n", "a", "A", "a b c", "A  B\tc", "...", long, long + " end", texts[0], texts[0]]
    rng.shuffle(texts)
    return [(None if i % 11 == 5 else i, t, "i", None, "r", 1, 2, 3) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = odd_texts()
    rows += rows[4:9]  # repeated rows
    return spark.createDataFrame(rows, DOCS).repartition(5), rows


def ranked(docs, items, k=10):
    """[(item, rank, doc_id, score)] by the formula itself."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(d, Counter(cut(t))) for d, t in docs if cut(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            m = treap.length_norm(sum(c.values()), n, length)
            score = sum(treap.weight(df[t], n) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(cut(text)) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k])]
    return out


def by_key(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("block_terms,width", [(400, 1), (5000, 8), (1 << 20, 64)])
def test_search_equals_the_formula(spark, odd, block_terms, width):
    df, rows = odd
    asked = [(i, t) for i, t in enumerate([rows[0][1], "w1 w2 w1 É", "nothing here", None, "w3", rows[9][1], "a b x1"])]
    asked += [(None, "w5 w6"), (4, "w7")]  # a null id and a repeated one
    items = spark.createDataFrame(asked, "item_id long, text string")
    got = treap.search(df, items, block_terms=block_terms, width=width).collect()
    assert by_key(map(tuple, got)) == by_key(ranked([(r[0], r[1]) for r in rows], asked))


def test_search_without_rows(spark, odd):
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert treap.search(odd[0].where("false"), items).count() == 0
    assert treap.search(odd[0], items.where("false")).count() == 0
    assert treap.search(odd[0].where("text is null"), items).count() == 0


def test_search_opens_few_ranges():
    """Best-first search leaves most documents of a block unread."""
    rng = np.random.default_rng(5)
    names, docs = treap._Numbers(), []
    for i in range(4000):
        own = [b"t%d" % t for t in rng.zipf(1.4, 40) if t < 5000]
        own += [b"rare"] * (i % 997 == 0)
        docs.append((i, np.fromiter(map(names.__getitem__, own), np.int64, len(own))))
    b = treap._block(docs, names, 4000, sum(len(t) for _, t in docs))
    of = lambda k, t: np.frombuffer(b[k], t)
    tree = treap.Treap(b["height"], of("mask", np.uint8), of("drop", np.int32), of("leaf_row", np.int32), of("leaf_col", np.int32))
    tree.unfold()
    row = {t: i for i, t in enumerate(b["words"].split(b"\n"))}
    search = treap.Search(5, width=1)
    search.run(tree, 1, np.zeros(2, np.int64), np.array([row[b"rare"], row[b"t1"]]), np.array([9000, 10]),
               of("doc_ids", np.int64), of("no_id", np.uint8).astype(bool))
    assert sorted(d % 997 for d in search.doc) == [0] * 5 and search.opened < 400


def test_index_rows_have_row_groups_of_their_own(spark, odd):
    """Spark reads one block at a time, however many a file has."""
    index, _, _ = treap.build(odd[0], block_terms=400)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert len(groups) == index.count() > 3 * len(files)
    assert not any(g.column(i).has_dictionary_page or g.column(i).is_stats_set for g in groups for i in range(g.num_columns))


def test_search_in_parts_holds_less_memory():
    """Many items at once, and the same ones in parts: the same finds with a share of the memory."""
    rng = np.random.default_rng(7)
    names, docs = treap._Numbers(), []
    for i in range(1500):
        own = [b"t%d" % t for t in rng.integers(0, 300, 40)]
        docs.append((i, np.fromiter(map(names.__getitem__, own), np.int64, len(own))))
    b = treap._block(docs, names, 1500, 60_000)
    of = lambda k, t: np.frombuffer(b[k], t)
    tree = treap.Treap(b["height"], of("mask", np.uint8), of("drop", np.int32), of("leaf_row", np.int32), of("leaf_col", np.int32))
    tree.unfold()
    items, terms = 300, 10
    item = np.repeat(np.arange(items), terms)
    item[-terms:] = items - 2  # the last one has no term here
    row, w = rng.integers(0, 300, len(item)), rng.integers(1, 5000, len(item))
    ids, no_id = of("doc_ids", np.int64), of("no_id", np.uint8).astype(bool)
    found, most = [], []
    for run in (lambda s: s.run(tree, items, item, row, w, ids, no_id),
                lambda s: s.run_parts(tree, items, item, row, w, ids, no_id, of("df", np.int32), 20_000),
                lambda s: s.run_parts(tree, items, item, row, w, ids, no_id, of("df", np.int32), 1)):
        search = treap.Search(5)
        tracemalloc.start()
        run(search)
        most.append(tracemalloc.get_traced_memory()[1])
        run(search)  # the next block, with finds already held
        tracemalloc.stop()
        found.append([*zip(search.item.tolist(), search.score.tolist(), search.doc.tolist())])
    assert found[0] == found[1] == found[2] and len(found[0]) == 5 * (items - 1)
    assert most[0] > 4 * most[1] > 4 * most[2]


def negatives(rows, every=100):
    q = []
    for vec_id, label, v in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q.append((vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label,
                  [int(np.floor(256 * float(x))) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = lambda i: (i is None, i or 0)
    out = []
    for at, (a, la, va) in enumerate(q):
        if a is None or a % every:
            continue
        scored = [(dot(va, v), i, lb == la) for j, (i, lb, v) in enumerate(q) if j != at]
        pos = sorted(((-s, last(i), i) for s, i, same in scored if same))[:5]
        for p, _, pid in pos:
            neg = sorted((-s, last(i), i) for s, i, same in scored if not same and -30 * p <= 100 * s <= -90 * p)[:10]
            out += [(a, pid, r + 1, n[2], -p, -n[0]) for r, n in enumerate(neg)]
    return out


@pytest.mark.parametrize("scale,block_rows,anchors", [(1, 7, 3), (1, 2048, 4096), (1e4, 64, 2)])
def test_negatives_equal_brute_force(spark, scale, block_rows, anchors):
    rng = np.random.default_rng(7)
    rows = [(int(i), int(rng.integers(0, 3)), [float(x) for x in rng.normal(0, 0.3, 6) * scale]) for i in range(300)]
    rows += [(100, 1, rows[3][2]), (None, 1, rows[4][2]), (500, None, rows[5][2]), (501, 1, None), (502, 1, [1.0, None]),
             (503, 1, [float("nan")] * 6), (504, 2, [float("inf")] * 6), (600, 2, []), (601, 1, [1.0 * scale, 2.0 * scale]),
             (-200, 0, rows[6][2]), (-203, 2, rows[6][2])]
    rows += [(700 + i, i % 3, rows[7][2]) for i in range(40)]  # a common vector: ties go by vec_id
    rows += [(200, 0, rows[8][2])] * 2
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows],
                               "vec_id long, label int, embedding array<double>, score string").repartition(4)
    got = packed.mine(df, block_rows=block_rows, anchors=anchors).collect()
    assert by_key(map(tuple, got)) == by_key(negatives(rows))
    assert packed.mine(df.where("false")).count() == 0


def test_packing_is_exact():
    rng = np.random.default_rng(8)
    for n, low, high in ((64, -90, 120), (64, -(1 << 20), 1 << 20), (3, 0, 0), (5, -(1 << 25), 3)):
        layout = packed.Packing(n, low, high)
        q, a = rng.integers(low, high + 1, (70, n)), rng.integers(low, high + 1, (9, n))
        got = layout.scores(layout.pack(q), q.sum(axis=1), a)
        assert (got == q.astype(object) @ a.astype(object).T).all() and layout.wide == (layout.bits > 32)


def jaccard_components(rows, shingle=4, percent=85):
    sets = []
    for _, text in rows:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
        size = min(shingle, len(words))
        sets.append(frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if x and sets[j] and 100 * common >= percent * (len(x) + len(sets[j]) - common):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)] += [d] if d is not None else []
    return [(d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("bucket_tokens,cell_tokens", [(1 << 21, 1 << 21), (3000, 300)])
def test_join_equals_brute_force(odd, bucket_tokens, cell_tokens):
    df, rows = odd
    got = prefixtree.join(df, bucket_tokens=bucket_tokens, cell_tokens=cell_tokens).collect()
    want = jaccard_components([(r[0], r[1]) for r in rows])
    assert by_key(map(tuple, got)) == by_key(want)
    sizes = Counter(w[2] for w in want)
    assert max(sizes.values()) > 3  # the case has chains


def test_join_on_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert by_key(map(tuple, prefixtree.join(df).collect())) == by_key(jaccard_components(rows))
    assert prefixtree.join(df.where("false")).count() == 0
    assert prefixtree.join(df.limit(2).repartition(8)).count() == 2


def test_tree_walk_prunes():
    """Sets far apart in length or content are left without being read."""
    sets = [np.arange(i * 50, i * 50 + 50, dtype=np.int32) for i in range(40)]
    tree = prefixtree.PrefixTree(2000, [50] * 41)
    for i, x in enumerate(sets):
        assert tree.walk(i, x) == []
        tree.add(i, x)
    near = sets[7].copy()[1:]
    before = tree.visited
    assert tree.walk(40, near) == [7] and tree.visited - before <= 42
