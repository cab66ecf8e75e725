"""Language identification by the nearest of several clustered centroids per language.

A text's letters, lower-cased and with other characters as one space, give
byte n-grams of lengths 1 to 4, hashed to ``DIMS`` slots. Its vector is
(1 + ln tf) * idf, of length one. Document frequencies cover every training
text: each task sends one count per slot. The centroids are fitted by spherical
k-means on at most ``SAMPLE`` distinct training texts per language, the ones with the
smallest seeded hash, so that copies neither crowd out other texts nor count twice. A text takes the language of the centroid with the
greatest cosine; ``rejected`` says that the cosine is below the one that
all but ``REJECT`` of that centroid's sample reach.

Defined results: null texts and texts without a letter are `und` with score 0;
training rows with null text or lang teach nothing; a null doc_id falls into
fold 0; repeated rows are predicted alike; an empty table gives an empty
result, and without training rows all texts are `und`; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spindle.llm.common import arrow_rows, filled, fold, scratch_table

DIMS = 1 << 13
SAMPLE = 400  # documented bound: texts per language from which the centroids are fitted
CLUSTERS = 3
REJECT = 0.005
ROUNDS = 12
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def counts(text: str | None, dims: int = DIMS) -> np.ndarray | None:
    """How often each n-gram slot occurs; None if the text has no letter."""
    letters = _OTHER.sub(" ", (text or "").lower()).strip()
    if not letters:
        return None
    data = np.frombuffer(f" {letters} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    out, code = np.zeros(dims, np.int64), np.zeros(len(data), np.uint32)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    for n, m in enumerate(_MULTIPLIERS):
        if len(data) <= n:
            break
        code = (code[:len(data) - n] << np.uint32(8)) | data[n:]
        out += np.bincount((code * np.uint32(m)) >> shift, minlength=dims)
    return out


def vector(tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of the normalised TF-IDF vector."""
    at = np.flatnonzero(tf)
    v = (1 + np.log(tf[at])) * idf[at]
    length = np.sqrt(v @ v)
    return at, (v / length if length else v).astype(np.float32)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # (slots, centroids)
    langs: list[str]
    least: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        tf = counts(text, len(self.idf))
        if tf is None or not self.langs:
            return UNKNOWN, 0.0, True
        at, v = vector(tf, self.idf)
        cosine = v @ self.centroids[at]
        best = int(cosine.argmax())
        return self.langs[best], float(min(max(cosine[best], 0.0), 1.0)), bool(cosine[best] < self.least[best])


def _cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart rows; centroids, and each row's cosine to its own."""
    centers = [x.mean(axis=0)]
    for _ in range(1, min(k, len(x))):
        near = np.max([x @ (c / (np.linalg.norm(c) or 1)) for c in centers], axis=0)
        centers.append(x[int(near.argmin())])
    c = np.array([v / (np.linalg.norm(v) or 1) for v in centers], np.float32)
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].sum(axis=0)
                c[j] = m / (np.linalg.norm(m) or 1)
    cosine = x @ c.T
    return c, cosine


def fit(rows: DataFrame, dims: int = DIMS, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Learn from rows (text, lang), nulls already gone."""

    def frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(dims, np.int64), 0
        for pdf in frames:
            for t in pdf["text"]:
                if (tf := counts(t, dims)) is not None:
                    df += tf > 0
                    n += 1
        if n:
            yield pd.DataFrame({"slot": np.arange(-1, dims), "n": np.r_[n, df]})

    seen = {r["slot"]: r["n"] for r in rows.select("text").mapInPandas(frequencies, "slot int, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).collect()}  # dims + 1 rows at most
    if not seen:
        return Model(np.ones(dims), np.zeros((dims, 0), np.float32), [], np.zeros(0))
    idf = np.log((1 + seen[-1]) / (1 + np.array([seen[i] for i in range(dims)]))) + 1

    # Texts without a letter have no vector. A threshold on the seeded hash leaves a few distinct texts per language, whatever its size and copies.
    # Only (lang, hash) is dealt, one row per task and distinct text.
    hashed = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64(F.lit(7), "text"))
    size = hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("size"))
    size = scratch_table(size, "sizes")
    key = F.pmod("h", F.lit(1 << 30)) / F.lit(1 << 30)
    some = (hashed.withColumn("key", key).join(F.broadcast(size) if _few(size) else size, "lang")
            .where(F.col("key") * F.col("size") <= 2 * sample + 20).dropDuplicates(["lang", "h"]))

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            made = [(k, lang, tf) for k, lang, t in zip(pdf["key"], pdf["lang"], pdf["text"])
                    if (tf := counts(t, dims)) is not None]
            dense = []
            for _, _, tf in made:
                row = np.zeros(dims, np.float32)
                at, v = vector(tf, idf)
                row[at] = v
                dense.append(row.tobytes())
            yield pd.DataFrame({"key": [m[0] for m in made], "lang": [m[1] for m in made], "v": dense})

    made = scratch_table(some.select("key", "lang", "text")
                         .mapInPandas(filled(vectors), "key double, lang string, v binary"), "sample")
    best = (made.dropDuplicates(["lang", "key"])
            .withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("key")))
            .where(F.col("nth") <= sample))

    def centroids(own: pd.DataFrame) -> pd.DataFrame:
        """Of one language: ``sample`` rows at most."""
        own = own.sort_values("key")
        c, cosine = _cluster(np.frombuffer(b"".join(own["v"]), np.float32).reshape(len(own), dims), clusters)
        mine = cosine.argmax(axis=1)
        rows = [(own["lang"].iloc[0], j, c[j].tobytes(), float(np.quantile(cosine[mine == j, j], REJECT)))
                for j in range(len(c)) if (mine == j).any()]
        return pd.DataFrame(rows, columns=["lang", "no", "c", "least"])

    # Only centroids come back: ``clusters`` of ``dims`` numbers for each language.
    fitted = sorted(best.select("key", "lang", "v").groupBy("lang").applyInPandas(
        centroids, "lang string, no int, c binary, least double").collect(), key=lambda r: (r["lang"], r["no"]))
    centers = np.array([np.frombuffer(r["c"], np.float32) for r in fitted], np.float32).reshape(len(fitted), dims)
    return Model(idf, np.ascontiguousarray(centers.T), [r["lang"] for r in fitted], np.array([r["least"] for r in fitted]))


def _few(size: DataFrame, most: int = 10_000) -> bool:
    """Whether a table of one short row per language is small enough to send to every task."""
    return size.limit(most + 1).count() <= most


def predict(docs: DataFrame, train: Column | None = None, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learnt from the rows where ``train``
    holds (default: all but fold 0 of 5)."""
    spark = docs.sparkSession
    arrow_rows(spark)
    train = fold() != 0 if train is None else train
    rows = docs.select("doc_id", "text", "lang", train.alias("train"))
    model = spark.sparkContext.broadcast(fit(
        rows.where(F.col("train") & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang"), **options))

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def label(texts: pd.Series) -> pd.DataFrame:
        found = [model.value.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    return (rows.withColumn("p", label("text"))
            .select("doc_id", (~F.col("train")).alias("held_out"), "p.lang_pred", "p.score", "p.rejected"))
