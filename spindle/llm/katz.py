"""Katz backoff bigram model: Good-Turing discounts, exactly normalised backoff weights.

    P(w | h) = d(r) r / c(h)        r = c(h, w) > 0 in the training texts
             = a(h) P(w)            otherwise
    P(w)     = d(c) c / N           c = c(w) > 0, else the mass that the discounts left
    a(h)     = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over the same w)

A history without discounted counts divides by c(h) + 1 instead, so that some
mass is always left. An unseen history has a(h) = 1 and no seen words. A text
starts from a start symbol and ends with one end token.

How it runs. Texts are tokenised once into *blocks* (rows of a scratch table:
local word numbers per token, the local words and their training counts). A
block asks the word table, partitioned by word hash, once per distinct word,
and the bigram table, partitioned by history, once per distinct bigram; both
answer each block with numbers in the order of its questions. What is
shuffled are packed arrays of distinct words and bigrams per block, with
counts already combined. The words after a frequent history are dealt over
several buckets in proportion to its count; the partial sums of those
histories (at most one per bucket and history) are added up by Spark and are
fewer than twice the buckets, so every task does. No task's memory grows with
the corpus: blocks and buckets are sized in tokens.

Defined results: null and empty texts are one end token; a null id falls into
fold 0; repeated rows are scored alike and each counts in training; an empty
table gives an empty result; without training texts every probability is
one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import arrow_rows, filled, fold, scratch_table, text_bytes

BLOCK_TOKENS = 2_500_000
BUCKET_TOKENS = 2_500_000
K = 5  # counts above it are not discounted

RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, "
          "train_tokens long, base_score double, score double")


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes of the least width that holds them all."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def discounts(n: np.ndarray, k: int = K) -> np.ndarray:
    """d[0..k] from the numbers n[r] of types seen r times (r up to k + 1); 1 where
    Good-Turing has no proper value."""
    d = np.ones(k + 1)
    common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    if common < 1:
        for r in range(1, k + 1):
            if n[r] and n[r + 1]:
                x = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
                d[r] = x if 0 < x < 1 else 1.0
    return d


def _frame(rows: list[dict], columns: str) -> pd.DataFrame:
    """Rows with absent values as None, which Arrow takes as null in any type."""
    return pd.DataFrame([[r.get(c) for c in columns.split()] for r in rows], columns=columns.split(), dtype=object)


class Unigrams:
    """Discounted word probabilities by training count."""

    def __init__(self, tokens: int, types: int, n: np.ndarray) -> None:
        self.tokens, self.types, self.d = tokens, types, discounts(n)
        r = np.arange(K + 1)
        left = float(((1 - self.d) * r * n[:K + 1]).sum())
        self.total = tokens if left > 0 else tokens + 1
        self.unknown = (left or 1.0) / self.total if self.total else 1.0

    def __call__(self, count: np.ndarray) -> np.ndarray:
        d = self.d[np.minimum(count, K)] * (count <= K) + (count > K)
        return np.where(count > 0, d * count / max(self.total, 1), self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


class _Numbers(dict):
    """Numbers words from 1 in the order of first use; 0 is the end token."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


BLOCK = ("block long, doc_ids binary, no_id binary, train binary, lengths binary, tokens binary, "
         "words binary, counts binary, n_tokens long, n_train long, train_docs long")


def blocks(docs: DataFrame, train: Column, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Tokenise every text into the scratch table of blocks."""
    arrow_rows(docs.sparkSession)

    def flush(block: int, ids: list, train: list, tokens: list, names: _Numbers) -> pd.DataFrame:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.concatenate(tokens)
        used = np.repeat(np.array(train, bool), lengths)
        counts = np.bincount(flat[used], minlength=len(names) + 1)
        return pd.DataFrame([{
            "block": block,
            "doc_ids": np.array([0 if i is None else i for i in ids], np.int64).tobytes(),
            "no_id": np.array([i is None for i in ids], np.uint8).tobytes(),
            "train": np.array(train, np.uint8).tobytes(),
            "lengths": pack(lengths), "tokens": pack(flat),
            "words": zstandard.ZstdCompressor(level=3).compress(b"\n".join(names)), "counts": pack(counts),
            "n_tokens": len(flat), "n_train": int(used.sum()), "train_docs": sum(train),
        }])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, n = TaskContext.get().partitionId() << 32, 0
        ids, use, tokens, names = [], [], [], _Numbers()
        for pdf in frames:
            for i, absent, t, data in zip(pdf["doc_id"], pdf["no_id"], pdf["train"], pdf["data"]):
                words = data.lower().split()
                ids.append(None if absent else i)
                use.append(bool(t))
                tokens.append(np.array([*map(names.__getitem__, words), 0], np.int32))
                n += len(words) + 1
                if n >= block_tokens:
                    yield flush(block, ids, use, tokens, names)
                    block, n = block + 1, 0
                    ids, use, tokens, names = [], [], [], _Numbers()
        if ids:
            yield flush(block, ids, use, tokens, names)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                       F.col("doc_id").isNull().alias("no_id"), train.alias("train"), text_bytes().alias("data"))
    return scratch_table(rows.mapInPandas(run, BLOCK), "blocks")


def _segments(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Stable order by bucket, and (bucket, from, to) of each bucket in that order."""
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    return order, [*zip(found.tolist(), starts.tolist(), [*starts.tolist()[1:], len(order)])]


def _word_segments(words: list[bytes], n_buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    h = xxhash.xxh64_intdigest
    return _segments(np.fromiter((h(w) % n_buckets for w in words), np.int64, len(words)))


def _words(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    return raw.split(b"\n") if raw else []


def word_table(table: DataFrame, n_buckets: int) -> DataFrame:
    """Answers (block, bucket, gid, count) for each block's words, in the block's order, and
    one row per bucket with block = -1: types and how many of them were seen 1..K+1 times."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for block, data, counts in zip(pdf["block"], pdf["words"], pdf["counts"]):
                words, counts = _words(data), unpack(counts)[1:]
                order, parts = _word_segments(words, n_buckets)
                yield _frame([{
                    "bucket": b, "block": block, "counts": pack(counts[order[lo:hi]]),
                    "words": zstandard.compress(b"\n".join([words[i] for i in order[lo:hi].tolist()])),
                } for b, lo, hi in parts], "bucket block words counts")

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        names, local, counts = _Numbers(), [], []
        for words, c in zip(pdf["words"], pdf["counts"]):
            local.append(np.array([*map(names.__getitem__, _words(words))], np.int64))
            counts.append(unpack(c))
        total = np.bincount(np.concatenate(local), weights=np.concatenate(counts), minlength=len(names) + 1)
        total, bucket = total.astype(np.int64), int(pdf["bucket"].iloc[0])
        rows = [{"block": b, "bucket": bucket, "gid": pack((at - 1) * n_buckets + bucket + 1),
                 "count": pack(total[at])} for b, at in zip(pdf["block"], local)]
        seen = np.bincount(np.minimum(total[1:], K + 2), minlength=K + 3)
        rows.append({"block": -1, "bucket": bucket, "types": int((total > 0).sum()), "n": seen[:K + 2].tolist()})
        return _frame(rows, "block bucket gid count types n")

    asked = table.select("block", "words", "counts").mapInPandas(
        filled(ask), "bucket long, block long, words binary, counts binary")
    return scratch_table(asked.groupBy("bucket").applyInPandas(
        answer, "block long, bucket long, gid binary, count binary, types long, n array<long>"), "words")


class _Block:
    """One block with the word table's answers: its distinct bigrams and where they are asked for."""

    def __init__(self, row: pd.Series, answers: pd.DataFrame, n_buckets: int, share: float, train_docs: int) -> None:
        words = _words(row["words"])
        self.gid = np.zeros(len(words) + 1, np.int64)  # 0: the end token, or as history the start
        self.count = np.zeros(len(words) + 1, np.int64)
        order, parts = _word_segments(words, n_buckets)
        answers = answers.set_index("bucket")
        for b, lo, hi in parts:
            self.gid[order[lo:hi] + 1] = unpack(answers.at[b, "gid"])
            self.count[order[lo:hi] + 1] = unpack(answers.at[b, "count"])
        self.count[0] = train_docs
        self.tokens = unpack(row["tokens"])
        self.lengths = unpack(row["lengths"])
        width = len(words) + 1
        # A text's first token follows the end token of the text before: number 0, the start.
        key = np.concatenate([[0], self.tokens[:-1]]) * width + self.tokens
        self.pair, self.inverse = np.unique(key, return_inverse=True)
        self.h, self.w = self.pair // width, self.pair % width
        # A history with more than a bucket's share of tokens has its words dealt over several.
        self.spread = np.maximum(1, np.ceil(self.count / max(share, 1))).astype(np.int64)
        mix = (self.gid * 0x9E3779B1) % (1 << 31)
        self.bucket = (mix[self.h] + mix[self.w] % self.spread[self.h]) % n_buckets
        self.order, self.parts = _segments(self.bucket)


def bigram_table(table: DataFrame, words: DataFrame, n_buckets: int, share: float, train_docs: int,
                 unigrams: Unigrams) -> DataFrame:
    """Answers (block, bucket, r, history sums) for each block's bigrams in the block's order; with
    block = -1 the partial sums of spread histories (h), and those of how often r occurs (n)."""

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf[pdf["tokens"].notna()].iloc[0]
        x = _Block(row, pdf[pdf["gid"].notna()], n_buckets, share, train_docs)
        used = np.repeat(np.frombuffer(row["train"], np.uint8).astype(bool), x.lengths)
        seen = np.bincount(x.inverse[used], minlength=len(x.pair))
        rows = []
        for b, lo, hi in x.parts:
            at = x.order[lo:hi]
            h, w = x.h[at], x.w[at]
            rows.append({"bucket": b, "block": row["block"], "h": pack(x.gid[h]), "w": pack(x.gid[w]),
                         "r": pack(seen[at]), "c": pack(x.count[w]), "spread": pack(x.spread[h] > 1)})
        return _frame(rows, "bucket block h w r c spread")

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        take = lambda name: [unpack(v) for v in pdf[name]]
        parts = take("h")
        h, w, r = np.concatenate(parts), np.concatenate(take("w")), np.concatenate(take("r"))
        order = np.lexsort((w, h))
        new = np.r_[True, (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)]
        first = np.flatnonzero(new)
        total = np.add.reduceat(r[order], first)
        at = order[first]
        hist = h[at]
        h_first = np.flatnonzero(np.r_[True, np.diff(hist) != 0])
        p = np.where(total > 0, unigrams(np.concatenate(take("c"))[at]), 0.0)
        sums = np.add.reduceat(p, h_first)
        each = [np.add.reduceat((total == i).astype(np.int64), h_first) for i in range(1, K + 1)]
        names = hist[h_first]
        r_of = np.empty(len(order), np.int64)
        r_of[order] = total[np.cumsum(new) - 1]
        bucket, rows, lo = int(pdf["bucket"].iloc[0]), [], 0
        for block, own in zip(pdf["block"], parts):
            runs = own[np.flatnonzero(np.r_[True, np.diff(own) != 0])]
            k = np.searchsorted(names, runs)
            rows.append({"block": block, "bucket": bucket, "r": pack(r_of[lo:lo + len(own)]),
                         "sums": zstandard.compress(sums[k].tobytes()),
                         "each": pack(np.concatenate([e[k] for e in each]))})
            lo += len(own)
        wide = np.concatenate(take("spread"))[at][h_first] > 0
        for i in np.flatnonzero(wide):
            rows.append({"block": -1, "bucket": bucket, "h": int(names[i]), "p": float(sums[i]),
                         "n": [0, *(int(e[i]) for e in each), 0]})
        rows.append({"block": -1, "bucket": bucket,
                     "n": np.bincount(np.minimum(total, K + 2), minlength=K + 3)[:K + 2].tolist()})
        return _frame(rows, "block bucket r sums each h p n")

    both = table.select("block", "train", "lengths", "tokens", "words").unionByName(
        words.where("block >= 0").select("block", "bucket", "gid", "count"), allowMissingColumns=True)
    asked = both.groupBy("block").applyInPandas(
        ask, "bucket long, block long, h binary, w binary, r binary, c binary, spread binary")
    out = "block long, bucket long, r binary, sums binary, each binary, h long, p double, n array<long>"
    return scratch_table(asked.groupBy("bucket").applyInPandas(answer, out), "bigrams")


def _totals(df: DataFrame, n: int = K + 2) -> np.ndarray:
    row = df.agg(*[F.sum(F.col("n")[i]) for i in range(n)]).first()
    return np.array([x or 0 for x in row], np.int64)


def score_texts(docs: DataFrame, train: Column | None = None, block_tokens: int = BLOCK_TOKENS,
                bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Score every text under the model of the texts where ``train`` holds (default: fold 1 of 5 is held out)."""
    train = fold() != 1 if train is None else train
    table = blocks(docs.select("doc_id", "text"), train, block_tokens)
    size = table.agg(F.sum("n_tokens"), F.sum("n_train"), F.sum("train_docs")).first()
    if size[0] is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    n_tokens, n_train, train_docs = size
    n_buckets = max(1, -(-n_tokens // bucket_tokens))
    share = n_train / n_buckets

    words = word_table(table, n_buckets)
    stats = words.where("block = -1")
    n = _totals(stats)
    types = int(stats.agg(F.sum("types")).first()[0] or 0) + (train_docs > 0)
    if 0 < train_docs <= K + 1:
        n[train_docs] += 1
    unigrams = Unigrams(n_train, types, n)

    bigrams = bigram_table(table, words, n_buckets, share, train_docs, unigrams)
    d = discounts(_totals(bigrams.where("block = -1 and h is null")))
    # At most twice as many rows as buckets: a history has parts in proportion to its tokens.
    wide = {r["h"]: (r["p"], np.array(r["n"], float)) for r in
            bigrams.where("block = -1 and h is not null").groupBy("h")
            .agg(F.sum("p").alias("p"), F.array(*[F.sum(F.col("n")[i]) for i in range(1, K + 1)]).alias("n"))
            .collect()}

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf[pdf["tokens"].notna()].iloc[0]
        x = _Block(row, pdf[pdf["gid"].notna()], n_buckets, share, train_docs)
        answers = pdf[pdf["r"].notna()].set_index("bucket")
        r = np.empty(len(x.pair), np.int64)
        sums, each = np.zeros(len(x.gid)), np.zeros((K, len(x.gid)))
        for b, lo, hi in x.parts:
            at = x.order[lo:hi]
            r[at] = unpack(answers.at[b, "r"])
            runs = x.h[at][np.flatnonzero(np.r_[True, np.diff(x.h[at]) != 0])]
            sums[runs] = np.frombuffer(zstandard.decompress(answers.at[b, "sums"]))
            each[:, runs] = unpack(answers.at[b, "each"]).reshape(K, -1)
        for i in np.unique(x.h[x.spread[x.h] > 1]).tolist():
            sums[i], each[:, i] = wide[int(x.gid[i])]
        c = x.count
        cut = ((1 - d[1:]) * np.arange(1, K + 1)) @ each
        total = np.where(cut > 0, c, c + 1)
        left = np.where(cut > 0, cut, 1.0) / np.maximum(total, 1)
        backoff = np.where(c > 0, left / np.maximum(1 - sums, 1e-300), 1.0)
        p_word, base = unigrams(c), unigrams.base(c)
        seen = (d[np.minimum(r, K)] * (r <= K) + (r > K)) * r / np.maximum(total[x.h], 1)
        p = np.log10(np.where(r > 0, seen, backoff[x.h] * p_word[x.w]))
        starts = np.r_[0, np.cumsum(x.lengths)[:-1]]
        no_id = np.frombuffer(row["no_id"], np.uint8) > 0
        ids = pd.Series(np.frombuffer(row["doc_ids"], np.int64)).astype("Int64").mask(no_id)
        return pd.DataFrame({
            "doc_id": ids, "held_out": np.frombuffer(row["train"], np.uint8) == 0, "n_tokens": x.lengths,
            "n_known": np.add.reduceat((c > 0).astype(np.int64)[x.tokens], starts), "train_tokens": n_train,
            "base_score": np.add.reduceat(base[x.tokens], starts),
            "score": np.add.reduceat(p[x.inverse], starts)})

    both = (table.select("block", "doc_ids", "no_id", "train", "lengths", "tokens", "words")
            .unionByName(words.where("block >= 0").select("block", "bucket", "gid", "count"), allowMissingColumns=True)
            .unionByName(bigrams.where("block >= 0").select("block", "bucket", "r", "sums", "each"),
                         allowMissingColumns=True))
    return both.groupBy("block").applyInPandas(score, RESULT)
