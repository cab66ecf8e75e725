"""Text operators against brute force, on small tables with every odd case."""

import hashlib
import importlib.util
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spindle.llm import bpe, cws, katz, langid, licenses, mixing, pii, quality, sharding, simhash
from spindle.llm.common import components, fold_of
from tests.conftest import SF_SMALL

ODD = "doc_id long, text string, lang string, source string, n_chars long, `row` string, fp string, ids int, copy int, w string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    line = " ".join(words[:40])
    texts = [None, "", " \n\t", "a", "A b", line, line, line + " x", long, long + "\n" + line, "é ü 日本 🙂", "!!! ??? 123",
             "licensed under the MIT License. mail a.b@c.de or +1 (803) 555-5351", "\n".join([line] * 4), "x" * 5000, None]
    rows = [(i if i % 7 else None, t, [None, "en", "de"][i % 3], [None, "s", "t"][i % 3], None, "r", None, i, None, "w")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[4:8], ODD), rows + rows[4:8]


@pytest.fixture(scope="module")
def small(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return df, df.collect()


def _union_find(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(200 + i, 201 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = _union_find(241, links)
    assert got == {i: want[i] for i in range(241) if i in {x for a, b in links if a != b for x in (a, b)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("max_tree", [4096, 3])
def test_simhash_links_everything_within_the_radius(spark, odd, small, max_tree):
    for df, rows in (odd, small):
        texts = [(r[0], (r[1] or "").encode()) for r in rows]
        fps = [simhash.fingerprint(t) for _, t in texts]
        root = _union_find(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                                       if (fps[i] ^ fps[j]).bit_count() <= 3])
        least = defaultdict(list)
        for i, r in enumerate(root):
            least[r].append(texts[i][0])
        want = Counter((texts[i][0], f"{fps[i]:016x}", min((x for x in least[root[i]] if x is not None), default=None))
                       for i in range(len(rows)))
        assert Counter(map(tuple, simhash.near_duplicates(df, max_tree=max_tree).collect())) == want


def test_simhash_keeps_one_row_of_each_component(odd):
    df, rows = odd
    kept = simhash.keep_one(df)
    fps = [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    root = _union_find(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert kept.columns == df.columns and kept.count() == len(set(root))


def test_licenses(odd, small):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for df, rows in (odd, small):
        want = Counter()
        for r in rows:
            w, at, labels = re.findall(licenses.WORD, (r[1] or "").translate(upper)), [], set()
            for phrase, label in licenses.BASE:
                p = phrase.split()
                hits = [i for i in range(len(w)) if w[i:i + len(p)] == p]
                at += hits
                labels |= {label} if hits else set()
            want[r[0], len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))] += 1
        got = licenses.scan(df).collect()
        assert Counter(tuple(r)[:6] for r in got) == want
        for r in got:
            assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_license_spans_survive_small_edits(spark):
    whole = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met")
    texts = [whole, whole.replace("binary forms", "binary or other forms"), whole[:40], "in source and with or without"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in got] == ["bsd", "bsd", "", ""] and got[0].score == 1 > got[1].score > 0.75


def test_quality_base_columns(odd, small):
    for df, rows in (odd, small):
        want = Counter()
        for r in rows:
            t = r[1] or ""
            w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
            lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            windows, covered = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set()
            for i in range(len(w) - 7):
                if windows[tuple(w[i:i + 8])] > 1:
                    covered.update(range(i, i + 8))
            failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
            want[r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                 len(covered), failed] += 1
        labels = df.sparkSession.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
        got = quality.rate(df, labels).collect()
        assert Counter(tuple(r)[:7] for r in got) == want and not any(r.base_failed and r.kept for r in got)
        kept = quality.keep(df, labels)
        assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)


def test_quality_cutoffs_hold_the_exact_bound(spark):
    rng = random.Random(5)
    rows = [(i, lang, 100, 500, int(100 * (rng.random() * 0.3 if i % 3 else 0.5 + rng.random())), 10, 0, 0)
            for i, lang in enumerate(["a", "b"] * 4000)] + [(8000 + i, "c", 100, 500, 0, 10, 0, 0) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, "
                               "n_lines long, n_dup_lines long, n_repeat_words long")
    labels = spark.createDataFrame([(r[0], int(r[0] % 3 > 0)) for r in rows], "doc_id long, quality int")
    cuts = {r.lang: r for r in quality.cutoffs(df, labels, risk=0.04, error=0.05).collect()}
    assert set(cuts) == {"a", "b"}  # too few labels in c
    bound = 0.05 / 4 / 3
    for lang, cut in cuts.items():
        good = [r[4] / 100 for r in rows if r[1] == lang and r[0] % 3]
        k, n = sum(v > cut.cut_symbols for v in good), len(good)
        tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(0.01)
                            + (n - j) * math.log(0.99)) for j in range(k + 1))
        assert tail <= bound and cut.cut_lines is None


def test_pii_base_spans_equal_plain_patterns():
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        twice = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in found.split(".")),
                "card": 14 <= len(digits) <= 19 and twice % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]

    rng = random.Random(3)
    for _ in range(4000):
        t = "".join(rng.choice("0123456789" * 2 + "..--  ()@@+++aZ%_é\n") for _ in range(rng.randrange(60)))
        want = sorted(((*m.span(), k) for k, p in plain.items() for m in re.finditer(p, t) if valid(k, m[0])),
                      key=lambda s: (s[0], pii.KINDS.index(s[2])))
        assert pii.base_spans(t) == want


def test_pii_learns_adds_and_redacts(spark, odd):
    rng = random.Random(6)
    number = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    texts = [f"call +1 {number()} now" for _ in range(800)] + [f"at {'.'.join(str(rng.randrange(256)) for _ in range(4))} up" for _ in range(800)]
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.fit(train)
    assert "phone" in model.thresholds
    assert pii.spans("dial 1 (803) 555-5351 today", model) == ([], [(5, 21, "phone")])
    df, rows = odd
    got = pii.find(df, model).collect()
    assert len(got) == len(rows) and sum(r.n_email for r in got) == 1 and sum(r.n_phone for r in got) == 1
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if not r.spans)
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    assert clean.where("text like '%mail [EMAIL] or [PHONE]'").count() == 1 and clean.where("text is null").count() == 2


def test_pii_thresholds_count_every_distinct_text(spark):
    rng = random.Random(7)
    number = lambda: f"({rng.randrange(200, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
    ips = [f"at {'.'.join(str(rng.randrange(256)) for _ in range(4))} up" for _ in range(9_000)]
    phones = [f"call +1 {number()} now" for _ in range(300)]
    once = pii.fit(spark.createDataFrame([(t,) for t in phones + ips], "text string"), sample_candidates=800)
    assert "phone" in once.thresholds  # rare beside the other kind, and beyond the sample's bound
    copies = spark.createDataFrame([(t,) for t in phones + ips + [ips[0]] * 2000], "text string")
    assert pii.fit(copies, sample_candidates=800).thresholds == once.thresholds
    few = [f"call +1 {number()} now" for _ in range(8)]  # too few texts, however often they are repeated
    assert "phone" not in pii.fit(spark.createDataFrame([(t,) for t in few * 60 + ips[:800]], "text string")).thresholds


def test_pii_adds_spelt_out_addresses(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 9)))
    texts = [f"mail {word()}@{word()}.org today" for _ in range(1500)] + [f"they look at {word()} dot com now" for _ in range(300)]
    model = pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    df = spark.createDataFrame([("mail gadeb (at) bachef (dot) org today",), ("they look at bachef dot com now",)], "text string")
    assert [r.text for r in pii.redact(df, model).collect()] == ["mail [EMAIL] today", "they look at bachef dot com now"]


def test_pii_finds_numbers_without_their_mark(spark):
    """Half the numbers are national: they are found, and dates, prices, versions, bad sums and other numbers are not."""
    rng = random.Random(12)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    number = lambda: f"({rng.randrange(200, 999)}) {d(3)}-{d(4)}"
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 9)))
    base = [f"{word()} +1 {number()} {word()}" for _ in range(1500)] + [f"{word()} {word()}@{word()}.org {word()}" for _ in range(600)]
    hidden = [(f"{word()} {number()} {word()}", True) for _ in range(1500)]
    others = [(f"{word()} {x} {word()}", False) for _ in range(300) for x in (
        f"20{d(2)}-0{rng.randrange(1, 9)}-1{d(1)}", f"{rng.randrange(10, 99)} {d(3)}.{d(2)}", f"{d(2)}.{d(2)}.{d(3)}", f"{d(3)} {d(3)}")]
    others += [(f"they look at {word()} dot com", False) for _ in range(200)]
    rows = [(t, None) for t in base] + hidden + others
    model = pii.fit(spark.createDataFrame([(t,) for t, _ in rows], "text string"))
    assert {"phone", "email"} <= set(model.thresholds) and min(model.recall.values()) >= 0.9
    found = [(bool(pii.spans(t, model)[1]), truth) for t, truth in hidden + others]
    hits = sum(f and t for f, t in found)
    assert hits >= 0.9 * len(hidden) and hits >= 0.95 * sum(f for f, _ in found)


@pytest.mark.parametrize("kind,text", [("card", "9436346619525194"), ("ip", "300.1.2.3"), ("ip", "1, 2, 3, 4"), ("phone", "2024-03-15"),
                                       ("phone", "12 345.67"), ("phone", "10.42.118"), ("email", "look at noon.Then5")])
def test_pii_rules_exclude(kind, text):
    assert pii.excluded(f"so {text} it", (3, 3 + len(text), kind), set())
    for body in ("4952935900253052", "27.148.129.95", "+1 (528) 555-3435", "are.43@mail4.example.com"):
        own = pii.base_spans(body)[0][2]
        bad = pii.spoiled(body, own)
        assert bad == pii.spoiled(body, own) and pii.excluded(bad, (0, len(bad), own), set())
        assert not any(pii.excluded(m, (0, len(m), own), set()) for m in pii.masked(body, own))


def test_pii_threshold_needs_the_precision():
    top = len(pii.EDGES) - 1
    assert pii.threshold({top: (400, 0), 5: (100, 0), 3: (10, 400)}) == pii.EDGES[5]
    assert pii.threshold({top: (20, 0)}) is None and pii.threshold({top: (10**8, 10**7)}) is None
    assert pii.threshold({top: (10**9, 10**6), -1: (5, 10**9)}) == pii.EDGES[top]
    for k, n in ((0, 60), (3, 100), (12, 200)):
        assert pii._at_most(k, n, 0.05) == pytest.approx(sum(math.comb(n, i) * 0.05**i * 0.95**(n - i) for i in range(k + 1)))


def test_language_accuracy_on_held_out_texts(spark, odd):
    df = spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet")
    lang = {r.doc_id: r.lang for r in df.collect()}
    got = langid.predict(df).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if fold_of(i) == 0}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95
    out = langid.predict(odd[0]).collect()
    assert len(out) == len(odd[1]) and sum(r.lang_pred == "und" for r in out) >= 5
    assert {r.lang_pred for r in langid.predict(odd[0].where("false").unionByName(odd[0].withColumn("lang", odd[0].fp))).collect()} == {"und"}


def test_language_sample_survives_copies(spark):
    rng = random.Random(9)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30))
    few, many = [text("abcdef") for _ in range(3)], [text("uvwxyz") for _ in range(300)]
    hot = text("ghijkl")
    rows = [(t, "copied") for t in few for _ in range(4000)] + [(t, "plain") for t in many] + [(hot, "plain")] * 9000
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), sample=100)
    assert set(model.langs) == {"copied", "plain"}
    assert model.predict(few[0])[0] == "copied" and all(model.predict(t)[0] == "plain" for t in many)


def test_mixing_draws_the_target_rates(spark, odd):
    df, rows = odd
    out = mixing.replicate(df, {"s": 1.0, None: 1.0}, total=4000)
    assert out.columns == [c for c in df.columns if c != "copy"] + ["copy"]
    n = Counter(r.source for r in out.collect())
    assert set(n) == {"s", None} and all(abs(v - 2000) < 300 for v in n.values())
    many = spark.range(20000).selectExpr("id as doc_id", "'t' || id as text", "if(id % 3 = 0, 'x', 'y' || id % 5) as source")
    a, b = mixing.replicate(many), mixing.replicate(many.repartition(3))
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    copies = Counter(Counter(r.doc_id for r in a.where("source = 'y1'").collect()).values())
    rate = mixing.rates(many).where("source = 'y1'").first().rate
    size = many.where("source = 'y1'").count()
    for k in (1, 2, 3):
        p = math.exp(-rate) * rate**k / math.factorial(k)
        assert abs(copies[k] - p * size) < 5 * math.sqrt(size * p)


def test_mixing_draws_for_each_of_equal_rows(spark):
    """One text and no ids: the copies still follow the distribution and lie in all partitions."""
    same = spark.range(9000).selectExpr("cast(null as bigint) as doc_id", "'t' as text", "'x' as source", "id % 2 as other")
    rest = spark.range(9000).selectExpr("id as doc_id", "'t' || id as text", "'y' || id % 40 as source", "id as other")
    out = mixing.replicate(same.unionByName(rest)).where("source = 'x'")
    rate = mixing.rates(same.unionByName(rest)).where("source = 'x'").first().rate
    copies = Counter(r["copy"] for r in out.collect())  # rows with at least k copies
    for k in (1, 2, 3):
        p = 1 - sum(math.exp(-rate) * rate**i / math.factorial(i) for i in range(k))
        assert abs(copies[k] - 9000 * p) < 5 * math.sqrt(9000 * p)
    assert Counter(r.other for r in out.collect())[0] > 0.4 * out.count()
    rows = same.selectExpr("struct(*) as row", "source", "'n' as name")
    assert mixing.numbered(rows).select("name").distinct().count() == 9000  # by which copies are dealt, too


def test_mixing_leaves_a_copy_column_alone(spark):
    import corpus_pipeline

    docs = spark.range(200).selectExpr("id as doc_id", "'t' || id as text", "'s' as source", "-7 - id as copy")
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.columns == docs.columns and all(r["copy"] == -7 - r.doc_id for r in out.collect())


@pytest.mark.parametrize("shards,bucket_rows", [(24, 10_000), (5, 3)])
def test_sharding_equals_a_sort_by_fractional_rank(spark, odd, small, shards, bucket_rows):
    """The whole order by hand: rank in the source's seeded order, fractional rank, one sort, equal cuts."""
    for df, rows in (odd, small):
        got = sharding.assign(df, shards, bucket_rows=bucket_rows).collect()
        n = len(rows)
        buckets = max(sharding.LEAST_BUCKETS, -(-n // bucket_rows))
        of = {r.source: r.h for r in df.select("source", F.xxhash64(F.lit(sharding.SEED), "source").alias("h")).distinct().collect()}
        plain = {r.source: r.h for r in df.select("source", F.xxhash64("source").alias("h")).distinct().collect()}
        last = lambda v: (v is not None, v or 0)  # noqa: E731  nulls first, as Spark sorts
        ties = lambda r: (r.key, last(r.doc_id), r.text_crc32, r.size)
        by_source = defaultdict(list)
        for r in got:
            by_source[r.source].append(r)
        order = []
        for source, own in by_source.items():
            own.sort(key=lambda r: (r.key % buckets, *ties(r)))
            phase = (of[source] % (1 << 20) + 0.5) / (1 << 20)
            order += [((i + 1 - phase) / len(own), plain[source], ties(r), r) for i, r in enumerate(own)]
        order.sort(key=lambda x: x[:3])
        cuts = Counter()
        for at, (_, _, tie, r) in enumerate(order):
            shard = at * shards // n
            want = (shard, cuts[shard])
            cuts[shard] += 1
            if tie == (order[at - 1][2] if at else None) or at + 1 < n and tie == order[at + 1][2]:
                continue  # equal rows take their places in turn
            assert (r.shard, r.slot) == want
        assert Counter(r.shard for r in got) == cuts and max(cuts.values()) - min(cuts.values()) <= 1
        data = {(r[0], zlib.crc32((r[1] or "").encode())): len((r[1] or "").encode()) + 8 for r in rows}
        assert all(data[r.doc_id, r.text_crc32] == r.size and r.law == "rows" and r.grown_shard is None for r in got)


def test_sharding_is_proportional_and_gapless(spark, odd):
    many = spark.range(5000).selectExpr("id as doc_id", "'t' || id as text", "if(id % 3 = 0, 'x', 'y' || id % 50) as source")
    for df, n in ((odd[0], len(odd[1])), (many, 5000)):
        got = sharding.assign(df, bucket_rows=300).toPandas()
        sizes = got.groupby("shard").slot
        assert len(got) == n and all(sorted(s) == list(range(len(s))) for _, s in sizes)
        counts = sizes.count().reindex(range(24), fill_value=0)
        assert counts.max() - counts.min() <= 1
    parts = got.groupby(["shard", "source"]).size().unstack(fill_value=0)
    assert (parts.max() - parts.min()).max() <= 4


def test_fingerprints_estimate_generalised_jaccard(spark, odd, small):
    for df, rows in (odd, small):
        got = cws.next_likeness(df).collect()
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    rows = sorted(small[1], key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in cws.next_likeness(small[0]).collect()}
    off = []
    for i, r in enumerate(rows):
        following = rows[(i + 1) % len(rows)].text
        n = len(r.text) // 3
        changed = r.text[:len(r.text) - n] + following[:n]
        assert got[r.doc_id].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        terms = [Counter(zip(w, w[1:])) if len(w) > 1 else Counter(w) for w in
                 (t.encode().lower().split() for t in (r.text, changed))]
        off.append(got[r.doc_id].near_edited - sum((terms[0] & terms[1]).values()) / max(1, sum((terms[0] | terms[1]).values())))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.1


def _sampled_by_hand(text, samples):
    """Consistent weighted sampling term by term, from the same draws."""
    words = text.encode().lower().split()
    words = [b" ".join(p) for p in zip(words, words[1:])] if len(words) > 1 else words
    counts = Counter(xxhash.xxh64_intdigest(w) for w in words)
    best = [(np.inf, 0, 0)] * samples
    for term, weight in counts.items():
        r, c, b = cws._draws(np.array([term], np.uint64), samples)  # c: ln c - r
        t = np.floor(np.float32(np.log(weight)) / r + b) if weight > 1 else np.zeros_like(r)
        a = c - r * (t - b) if weight > 1 else c + r * b
        best = [min(x, (float(a[i, 0]), term, int(t[i, 0]))) for i, x in enumerate(best)]
    mask, out = (1 << 64) - 1, []
    for _, term, t in best:
        x = (term * 0x9E3779B97F4A7C15 ^ (t + 1) * 0xC2B2AE3D27D4EB4F & mask) & mask
        x ^= x >> 29
        out.append(max(1, (x * 0xBF58476D1CE4E5B9 & mask) >> 32))
    return np.array(out if counts else [0] * samples, np.uint32)


def test_fingerprints_equal_sampling_by_hand(small):
    texts = [r.text for r in small[1]][:50] + ["", "one", "a a a a a b b", "A a"]
    for text, following in zip(texts, texts[1:] + texts[:1]):
        own, other = cws.Drawn(text), cws.Drawn(following)
        assert (own.print == _sampled_by_hand(text, cws.SAMPLES)).all()
        changed = cws.edited(text, following)
        assert (cws.fingerprint_from(changed, [own, other]) == _sampled_by_hand(changed, cws.SAMPLES)).all()


def test_fingerprints_of_long_unrelated_texts_differ():
    long = [" ".join(f"{side}{i}" for i in range(200_001)) for side in "ab"]
    a, b = map(cws.fingerprint, long)
    assert cws.likeness(a, b) <= 1 / cws.SAMPLES
    half = cws.fingerprint(" ".join(long[0].split()[:100_000] + long[1].split()[:100_000]))
    assert abs(cws.likeness(a, half) - 1 / 3) < 0.2


def test_fingerprint_draws_follow_their_distributions():
    r, c, b = cws._draws(np.random.default_rng(1).integers(0, 1 << 64, 20_000, np.uint64), 16)
    for g in (r, np.exp(c + r)):
        for x in (0.1, 1.0, 3.0, 8.0):
            p = math.exp(-x) * (1 + x)
            assert abs((g > x).mean() - p) < 5 * math.sqrt(p * (1 - p) / g.size)
    assert abs(b.mean() - 0.5) < 0.005 and 0 <= b.min() and b.max() < 1
    assert max(abs(np.corrcoef(*(v.ravel() for v in pair))[0, 1]) for pair in ((r, np.exp(c + r)), (r, b), (b, c + r))) < 0.01


def test_katz_is_normalised_and_exact(spark, odd, small):
    for df, rows in (odd, small):
        texts = [(r[0], (r[1] or "").encode().lower().split() + [None]) for r in rows]
        train = [t for i, t in texts if fold_of(i) != 1]
        uni, pairs, hist = Counter(w for t in train for w in t), Counter(), Counter()
        for t in train:
            pairs.update(zip([b""] + t[:-1], t))
        for (h, _), n in pairs.items():
            hist[h] += n
        seen = lambda c: np.array([0, *(list(c.values()).count(i) for i in range(1, 7))])
        d, total = katz.discounts(seen(pairs)), sum(uni.values())
        model = katz.Unigrams(total, len(uni), seen(uni))
        p_of = lambda w: float(model(np.array([uni.get(w, 0)]))[0])
        assert sum(map(p_of, uni)) + p_of(b"\n") == pytest.approx(1)
        cut = lambda n: d[n] * n if n <= katz.K else n
        after = defaultdict(list)
        for (h, w), n in pairs.items():
            after[h].append((w, n))
        weight = {}
        for h, ws in after.items():
            mass = sum(cut(n) for _, n in ws)
            whole = hist[h] if mass < hist[h] - 1e-9 else hist[h] + 1
            weight[h] = (whole, (1 - mass / whole) / (1 - sum(p_of(w) for w, _ in ws)))

        def p(h, w):
            n = pairs.get((h, w), 0)
            return cut(n) / weight[h][0] if n else weight.get(h, (0, 1))[1] * p_of(w)

        for h in [b"", *list(after)[:3]]:
            assert sum(p(h, w) for w in uni) + p(h, b"\n") == pytest.approx(1)
        want = sorted((str(i), len(t), sum(uni.get(w, 0) > 0 for w in t),
                       sum(math.log10((uni.get(w, 0) + 0.5) / (total + 0.5 * (len(uni) + 1))) for w in t),
                       sum(math.log10(p(h, w)) for h, w in zip([b""] + t[:-1], t))) for i, t in texts)
        for blocks, buckets in ((9000, 4000), (katz.BLOCK_TOKENS, katz.BUCKET_TOKENS)):
            got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score)
                         for r in katz.score_texts(df, block_tokens=blocks, bucket_tokens=buckets).collect())
            assert [g[:3] for g in got] == [w[:3] for w in want]
            assert np.allclose([g[3:] for g in got], [w[3:] for w in want])


tokenizers = pytest.mark.skipif(not importlib.util.find_spec("public_tokenizers"), reason="no tokenizer files")


@tokenizers
def test_bpe_equals_the_public_encoder(spark, odd, small):
    from tokenizers import Tokenizer

    from spindle.llm.queries import tokenizer_path

    path = tokenizer_path()
    ref, own = Tokenizer.from_file(path), bpe.Codec(path, None)
    rng = random.Random(1)
    for i in range(400):
        s = "".join(rng.choice("aabehrstt  \n\t'“é1279.,<|>#日本語🙂\x1c ") for _ in range(rng.randrange(600)))
        s += ["", "<|endoftext|>" + s[:5] + "<|endoftext|><|endoftext|> x", "ab" * 400][i % 3]
        ids = ref.encode(s, add_special_tokens=False).ids
        assert own.encode(s) == ids and own.decode(ids) == ref.decode(ids, skip_special_tokens=False)
    for df, rows in (odd, small):
        want = Counter()
        for r in rows:
            ids = ref.encode(r[1] or "", add_special_tokens=False).ids
            told = [hashlib.sha256(x.encode()).hexdigest() for x in
                    (",".join(map(str, ids)), ref.decode(ids, skip_special_tokens=False))]
            want[r[0], len(ids), *told] += 1
        assert Counter(map(tuple, bpe.digests(df, path, words=500).collect())) == want


def test_transducer_shares_suffixes_and_finds_words():
    words = sorted({f"{a}{b}ing".encode() for a in "abcdefgh" for b in "klmnop"} | {b"", b"a", b"ing", "é".encode()})
    data = bpe.Transducer.compile([(w, [i, i + 1]) for i, w in enumerate(words)])
    found = bpe.Transducer(data)
    assert all(found.get(w) == [i, i + 1] for i, w in enumerate(words))
    assert found.get(b"akin") is None and found.get(b"zz") is None and np.frombuffer(data[:4], "i")[0] < 15
    assert bpe.Transducer(bpe.Transducer.compile([])).get(b"a") is None


def test_empty_tables(spark, odd):
    none, labels = odd[0].where("false"), spark.createDataFrame([], "doc_id long, quality int")
    outs = [licenses.scan(none), langid.predict(none), simhash.near_duplicates(none), simhash.keep_one(none),
            mixing.replicate(none), katz.score_texts(none), cws.next_likeness(none), quality.rate(none, labels),
            quality.keep(none, labels), pii.find(none), pii.redact(none), sharding.assign(none)]
    assert [df.count() for df in outs] == [0] * len(outs)


@tokenizers
def test_pipeline_equals_its_stages_by_hand(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "redact_pii", "mix_sources", "encode_bpe"]
    rate = {r.doc_id: r.kept for r in quality.rate(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()}
    kept = [r for r in docs.collect() if rate[r.doc_id]]
    fps = [simhash.fingerprint(r.text.encode()) for r in kept]
    root = _union_find(len(kept), [(i, j) for i in range(len(kept)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = defaultdict(list)
    for r, i in zip(kept, root):
        least[i].append(r.doc_id)
    one = {min(x) for x in least.values()}
    assert {r.doc_id for r in out} <= one and abs(len(out) - len(one)) < 5 * math.sqrt(len(one))
    codec = bpe.Codec(corpus_pipeline.tokenizer_path(), None)
    text = {r.doc_id: r.text for r in kept}
    for r in out[:40]:
        clean = codec.decode(list(r.ids))
        for lo, hi, _ in pii.base_spans(text[r.doc_id]):
            assert text[r.doc_id][lo:hi] not in clean
        assert r.n_tokens == len(r.ids) and (pii.base_spans(text[r.doc_id]) or clean == text[r.doc_id])
