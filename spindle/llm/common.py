"""Helpers shared by the text operators: scratch tables, text access, components."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.session import checkpoint_root

# Words of the base definitions: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Arrow batches handed to Python hold whole texts; this many rows bound their size.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def fold(name: str = "doc_id", folds: int = 5) -> Column:
    """crc32(id as text) mod ``folds``; a null id counts as empty text."""
    key = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(folds)).cast("int")


def fold_of(doc_id, folds: int = 5) -> int:
    """The same in Python."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/llm/{uuid.uuid4().hex}/{name}"


def scratch_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once, with the writer's ``options``, into the shared scratch folder and read it back.

    Later branches read the stored rows: nothing is computed twice, values
    that Spark would not repeat exactly (partition ids) are fixed, and a lost
    executor costs only the tasks that were running.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_rows(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows and bytes of an Arrow batch, as each row may carry a very long text. The
    settings are the session's and stay; they only ever fall."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{key}").removesuffix("b"))
        if now > most or now <= 0:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def filled(make: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]):
    """A ``mapInPandas`` function that sends no frame without rows: pandas gives empty columns
    a numeric type, which Arrow does not take for text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (pdf for pdf in make(frames) if len(pdf))

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for undirected edges (a, b) of long: root is the smallest node reachable.

    Alternating large-star and small-star rounds. Each round is a min
    aggregation (combined map-side, so a hub costs one row per task) and an
    equi-join that the planner may split where a hub is hot. Nodes without an
    edge to another node are absent from the result.
    """
    e = scratch_table(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = scratch_table(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaf = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    hub = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaf.unionByName(hub)


def runs(frames: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Regroup batches of rows sorted by ``key``: yields frames that never cut a
    run of equal keys in two."""
    rest = None
    for pdf in frames:
        if rest is not None and len(rest):
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        same = (pdf[key] == pdf[key].iloc[-1]).all(axis=1).to_numpy()
        cut = len(same) - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield pdf.iloc[:cut].reset_index(drop=True)
        rest = pdf.iloc[cut:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest
