"""Proportional stratified interleaving, in DataFrame operations.

Rows are ranked by a seeded hash within their source; the fractional rank
(rank - phase) / size orders all rows, where the phase is a hash of the
source, so that sources of one row each spread over the whole order. Cutting
that order into equal counts gives shards that hold every source in
proportion, give or take a few rows.

Ranks are found without a window over a whole source: rows fall into
buckets of about ``BUCKET_ROWS`` by hash (then by fractional rank), the buckets'
sizes are summed up along the order, and only rows of one bucket are sorted together.

Defined results: a null source is a source of its own; null texts have size 8
and CRC 0; equal rows are interchangeable, and each gets a slot of its own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spindle.llm.common import scratch_table, text_bytes

SHARDS = 24
SEED = 11
BUCKET_ROWS = 10_000
LEAST_BUCKETS = 256


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, and its source and text hash."""
    data = text_bytes()
    rows = scratch_table(docs.select(
        "doc_id", "source", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.xxhash64(F.lit(seed), "doc_id", data).alias("key")), "rows")
    n = rows.count()
    buckets = max(LEAST_BUCKETS, -(-n // bucket_rows))
    rows = rows.withColumn("bucket", F.pmod("key", F.lit(buckets)))

    sizes = rows.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    of_source = W.partitionBy("source")
    sizes = sizes.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.sum("n").over(of_source).alias("n_source"),
        F.coalesce(F.sum("n").over(of_source.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    ties = ["key", "doc_id", "text_crc32", "size"]
    phase = (F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 20)) + 0.5) / F.lit(float(1 << 20))
    rank = F.col("ahead") + F.row_number().over(W.partitionBy("source", "bucket").orderBy(*ties))
    ranked = (rows.join(sizes, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
              .withColumn("part", (rank - phase) / F.col("n_source"))
              .withColumn("bucket", F.floor(F.col("part") * buckets).cast("long"))
              .drop("s", "b", "n_source", "ahead"))
    ranked = scratch_table(ranked, "ranked")

    # One row per bucket: as short as the number of buckets.
    along = ranked.groupBy("bucket").agg(F.count("*").alias("n")).select(
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    at = F.col("ahead") + F.row_number().over(W.partitionBy("bucket").orderBy("part", F.xxhash64("source"), *ties)) - 1
    total = max(n, 1)
    return (ranked.join(along, F.col("bucket") == F.col("b")).withColumn("at", at)
            .withColumn("shard", F.expr(f"at * {shards} div {total}"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                    F.expr(f"at - (shard * {total} + {shards - 1}) div {shards}").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "source", "key"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write whole rows as ``shard=<n>`` folders, each sorted by slot; equal rows take their slots in turn."""
    own = W.partitionBy("doc_id", "key")
    slots = assign(docs, shards, seed).select(
        "doc_id", "key", "shard", "slot", F.row_number().over(own.orderBy("shard", "slot")).alias("nth"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id",
                       F.xxhash64(F.lit(seed), "doc_id", text_bytes()).alias("key"))
    rows = rows.withColumn("nth", F.row_number().over(own.orderBy(F.xxhash64("row"))))
    both = rows.alias("r").join(slots.alias("s"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id"))
                                & (F.col("r.key") == F.col("s.key")) & (F.col("r.nth") == F.col("s.nth")))
    (both.select("r.row", "s.shard", "s.slot").repartition("shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
