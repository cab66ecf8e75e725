"""Consistent weighted sampling fingerprints.

Terms are the text's word pairs (ASCII-lower-cased words; a single word is a
term of its own), weighted by how often they occur and known by their 64-bit
hash. For every term and sample, draws r, c ~ Gamma(2, 1) and b ~ U(0, 1), made
from a hash of (term, sample), give the improved consistent weighted sample

    t = floor(ln(weight) / r + b),   ln a = ln c - r (t - b) - r

and the sample is the term with the least a, together with its t. Two
fingerprints agree in a sample with probability equal to the generalised
Jaccard similarity sum(min) / sum(max) of the weighted terms, however long the
texts. A sample is stored as a 32-bit hash of (term, t), written as eight hex digits.

Defined results: null and empty texts have no terms and a fingerprint of
zeros, which is only like another such one; equal texts have equal
fingerprints; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spindle.llm.common import arrow_rows, filled, scratch_table

SAMPLES = 64
KEPT_TERMS = 1 << 14  # 256 bytes each at 64 samples
SEED = 20_240_601


@cache
def _keys(samples: int) -> np.ndarray:
    """One odd seed per sample, as a column; the same in every process."""
    return np.random.Generator(np.random.Philox(SEED)).integers(0, 1 << 64, (samples, 1), np.uint64) | np.uint64(1)


def _draws(terms: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c - r and b of every (sample, term). A Gamma(2, 1) draw is -ln(u v) of two uniform numbers; r, whose
    far tail decides in long texts, gets 32 bits for each."""
    x = (terms ^ (terms >> np.uint64(32))) * _keys(samples)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    y = x * np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    low = np.uint64(0xFFFFFFFF)
    r = (x & low).astype(np.float32) + np.float32(0.5)
    r *= (x >> np.uint64(32)).astype(np.float32) + np.float32(0.5)
    r = np.float32(64 * np.log(2)) - np.log(r)
    np.maximum(r, np.float32(1e-6), out=r)
    parts = y.view(np.uint16).reshape(*y.shape, 4)
    c = parts[..., 0].astype(np.float32) + np.float32(0.5)
    c *= parts[..., 1].astype(np.float32) + np.float32(0.5)
    c *= np.float32(2.0**-32)
    c = np.log(-np.log(c))
    c -= r
    return r, c, (y >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)


def weights(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's terms and their weights."""
    words = text.encode("utf-8", "replace").lower().split()
    if len(words) > 1:
        words = map(b" ".join, zip(words, words[1:]))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64), return_counts=True)


class Drawn:
    """The draws of a text's terms, made once: ``one`` holds ln a of every (sample, term) at weight 1. Texts of more than
    ``KEPT_TERMS`` terms keep none."""

    def __init__(self, text: str, samples: int = SAMPLES) -> None:
        self.term, self.weight = weights(text)
        keep = len(self.term) <= KEPT_TERMS
        self.one = np.empty((samples, len(self.term) if keep else 0), np.float32)
        self.print = _least([(self.term, self.weight, None, self.one if keep else None)], samples)


def _least(groups: list[tuple], samples: int, chunk: int = 512) -> np.ndarray:
    """The signature of terms in groups (terms ascending, weights, ln a at weight 1 where known, where to put
    it); equal values of a go to the smaller term, so the grouping does not show."""
    best, best_term, best_t = np.full(samples, np.inf, np.float32), np.zeros(samples, np.uint64), np.zeros(samples, np.uint64)
    every = np.arange(samples)

    def meet(own: np.ndarray, ln_a: np.ndarray, t: np.ndarray | None) -> None:
        at = ln_a.argmin(axis=1)
        low, term = ln_a[every, at], own[at]
        new = (low < best) | (low == best) & (term < best_term)
        best[new], best_term[new] = low[new], term[new]
        best_t[new] = 0 if t is None else t[every, at][new].astype(np.uint64)

    some = False
    for term, weight, known, put in groups:
        some = some or len(term) > 0
        if known is not None:
            if len(term):
                meet(term, known, None)
            continue
        log_w = np.log(weight).astype(np.float32)
        for lo in range(0, len(term), chunk):
            own, lw = term[lo:lo + chunk], log_w[lo:lo + chunk]
            r, c, b = _draws(own, samples)
            more, t = np.flatnonzero(lw), None
            if len(more):
                r2, b2 = r[:, more], b[:, more]
                t2 = np.floor(lw[more] / r2 + b2)
                own2 = c[:, more] - r2 * (t2 - b2)
            r *= b  # a single occurrence has t = 0, as b < 1
            c += r
            if put is not None:
                put[:, lo:lo + chunk] = c
            if len(more):
                t = np.zeros(c.shape, np.float32)
                t[:, more], c[:, more] = t2, own2
            meet(own, c, t)
    if not some:
        return np.zeros(samples, np.uint32)
    mixed = best_term * np.uint64(0x9E3779B97F4A7C15) ^ (best_t + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.maximum((mixed >> np.uint64(32)).astype(np.uint32), 1)


def fingerprint(text: str, samples: int = SAMPLES) -> np.ndarray:
    """``samples`` values of 32 bits; zeros if the text has no term."""
    term, weight = weights(text)
    return _least([(term, weight, None, None)], samples)


def fingerprint_from(text: str, sources: list[Drawn], samples: int = SAMPLES) -> np.ndarray:
    """The same, taking draws of terms that occur once from texts that share them."""
    term, weight = weights(text)
    left, groups = np.ones(len(term), bool), []
    once = weight == 1
    for source in sources:
        if source.one.shape[1] and len(term):
            at = np.minimum(np.searchsorted(source.term, term), len(source.term) - 1)
            has = left & once & (source.term[at] == term)
            groups.append((term[has], weight[has], source.one[:, at[has]], None))
            left &= ~has
    groups.append((term[left], weight[left], None, None))
    return _least(groups, samples)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated generalised Jaccard similarity."""
    return float((a == b).mean())


def bytes_of(a: np.ndarray) -> bytes:
    return a.astype(">u4").tobytes()


def text_of(a: np.ndarray) -> str:
    return bytes_of(a).hex()


def edited(text: str, following: str) -> str:
    """The last third of the code points gives way to as many first ones of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def with_fingerprint(df: DataFrame, out: str = "fingerprint", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``df`` plus the hex fingerprint of its text column."""
    arrow_rows(df.sparkSession)

    @F.pandas_udf("string")
    def cws(texts: pd.Series) -> pd.Series:
        return pd.Series([text_of(fingerprint(t or "", samples)) for t in texts])

    return df.withColumn(out, cws(F.col(text).cast("string")))


# Hashes and signatures stay bytes until the last step, which writes them as hex digits.
RESULT = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double")


def _result(rows: list[tuple], samples: int) -> pd.DataFrame:
    """Rows (doc_id, text, its draws, next text, its draws)."""
    out = []
    for doc_id, text, own, following, next_own in rows:
        changed = edited(text, following)
        f = fingerprint_from(changed, [own, next_own], samples)
        out.append((doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).digest(), bytes_of(own.print),
                    bytes_of(f), likeness(own.print, f), likeness(own.print, next_own.print)))
    return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")], dtype=object)


def next_likeness(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text and its edited text, compared with each other and with the
    next document's in descending doc_id (null ids last, ties by text hash, then text).

    Texts are dealt once, by range of that order; each task walks its range and sends, beside its results, the first
    and the last text of the range. Both are stored together, so the ranges are read once. The
    ends then meet in a join by the number of the range that follows.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                       F.col("doc_id").isNull().alias("absent"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("absent"), F.col("doc_id").desc(), F.xxhash64("text"), F.col("text")]
    ranges = rows.repartitionByRange(n, *order[:3]).sortWithinPartitions(*order)
    ends = ["part", "head", "tail"]

    def no_ends(rows: int) -> dict[str, np.ndarray]:
        return {c: np.full(rows, None, object) for c in ends}

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch, last, head = [], None, None
        for pdf in frames:
            for doc_id, absent, text in zip(pdf["doc_id"], pdf["absent"], pdf["text"]):
                now = (None if absent else int(doc_id), text, Drawn(text, samples))
                if last is None:
                    head = text
                else:
                    batch.append((*last, *now[1:]))
                last = now
                if len(batch) == 200:
                    yield _result(batch, samples).assign(**no_ends(len(batch)))
                    batch = []
        if batch:
            yield _result(batch, samples).assign(**no_ends(len(batch)))
        if last is not None:
            row = {"doc_id": last[0], "part": TaskContext.get().partitionId(), "head": head, "tail": last[1]}
            yield pd.DataFrame([[row.get(c) for c in [*columns, *ends]]], columns=[*columns, *ends], dtype=object)

    def outer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield _result([(None if absent else int(i), a, Drawn(a, samples), b, Drawn(b, samples))
                           for i, absent, a, b in zip(pdf["doc_id"], pdf["absent"], pdf["tail"], pdf["next"])], samples)

    columns = [c.split()[0] for c in RESULT.split(", ")]
    made = scratch_table(ranges.mapInPandas(filled(walk), f"{RESULT}, part int, head string, tail string"), "walked")
    # One short row per range goes through the window; the texts are joined to it.
    order_of = W.orderBy("part")
    parts = made.where("part IS NOT NULL").select("part").withColumn("follows", F.coalesce(
        F.lead("part").over(order_of), F.first("part").over(order_of.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    edge = made.where("part IS NOT NULL")
    pairs = (edge.join(parts, "part").select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("absent"),
                                             "tail", F.col("follows").alias("part"))
             .join(edge.select("part", F.col("head").alias("next")), "part"))
    every = made.where("part IS NULL").select(*columns).unionByName(
        pairs.repartition(min(n, 8)).mapInPandas(filled(outer), RESULT))
    return every.select(*[F.lower(F.hex(c)).alias(c) if kind == "binary" else F.col(c) for c, kind in every.dtypes])
