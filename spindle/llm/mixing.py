"""Mixing sources to target weights by Poisson replication, in DataFrame operations.

A source of n rows and weight w gets the mean repetition rate
w * total / (n * sum of weights). Every row draws its number of copies
from the Poisson distribution of that mean, by inverting its distribution
function at a uniform number that is the MD5 of (seed, part, doc_id, MD5 of the text), to which rows that repeat
doc_id and text add their number among these, so that all draws are independent. Such rows are found by
thin counts; where rows are equal throughout, they are counted and numbered again afterwards, so a group of any size
meets in no task. A mean
above ``PART`` is the sum of independent parts, so that the tables stay short. Copies
are numbered from 1 and dealt over the cluster by another hash.

Defined results: a null source is a source of its own; a weight for an absent
source is ignored, and a source without a given weight gets none of the rows;
rows that repeat doc_id and text are numbered in the order of a hash of all their columns and draw each for itself; null texts count as empty for the draw and stay null; an empty
table gives an empty result; all columns are returned as they came, plus the number of the copy,
which takes the place of a column of its name (``copy`` unless another is given).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SEED = 5
PART = 32.0
POWER = 0.5  # default weight of a source: its number of rows to this power
MOST_REPEATED = 200_000  # beyond it, the table of repeated names (some 60 bytes each) is not broadcast
MOST_SOURCES = 10_000  # beyond it, the table of rates (about 1 kB a source) is not broadcast


def poisson_table(mean: Column) -> Column:
    """The distribution function at 0, 1, ... far beyond any uniform number of 52 bits."""
    last = (mean + 12 * F.sqrt(mean) + 30).cast("int")
    none = F.exp(-mean)

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"),
                        F.concat(acc["out"], F.array(acc["sum"] + term)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), last), F.struct(none.alias("term"), none.alias("sum"), F.array(none).alias("out")),
                       add, lambda acc: acc["out"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, total: int | None = None) -> DataFrame:
    """(source, rate) of every source; default weights follow ``POWER``, default total is the number of rows."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(POWER)))
    else:
        given = docs.sparkSession.createDataFrame([*weights.items()], "s string, w double")
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    sums = sizes.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    wanted = float(sums["n"] or 0) if total is None else float(total)
    return sizes.select("source", (F.col("w") * F.lit(wanted) / (F.lit(float(sums["w"] or 1.0) or 1.0) * F.col("n"))).alias("rate"))


def numbered(rows: DataFrame) -> DataFrame:
    """(row, source, name) with the names told apart: the first of equal names stays, the nth gets ``|n``."""
    twice = rows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select(F.col("name").alias("again"))
    if twice.limit(MOST_REPEATED + 1).count() <= MOST_REPEATED:
        twice = F.broadcast(twice)
    marked = rows.join(twice, F.col("name") == F.col("again"), "left")
    alone = marked.where("again IS NULL").drop("again")
    # Equal rows become one with a count; the numbers of different rows of a name follow each other.
    groups = marked.where("again IS NOT NULL").groupBy("name", F.xxhash64("row").alias("h")).agg(
        F.count("*").alias("n"), F.any_value("row").alias("row"), F.any_value("source").alias("source"))
    ahead = F.coalesce(F.sum("n").over(W.partitionBy("name").orderBy("h").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    again = groups.withColumn("ahead", ahead).withColumn(
        "nth", F.explode(F.sequence(F.col("ahead"), F.col("ahead") + F.col("n") - 1)))
    told = F.when(F.col("nth") == 0, F.col("name")).otherwise(F.concat_ws("|", "name", F.col("nth").cast("string")))
    return alone.unionByName(again.select("row", "source", told.alias("name")))


def replicate(docs: DataFrame, weights: dict[str | None, float] | None = None, total: int | None = None,
              seed: int = SEED, copy: str = "copy") -> DataFrame:
    """``docs`` with every row as often as it is drawn, plus its number in column ``copy``, in an order shuffled over the cluster."""
    table = (rates(docs, weights, total)
             .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
             .withColumn("cdf", poisson_table(F.col("rate") / F.col("parts")))
             .select(F.col("source").alias("of"), "parts", "cdf"))
    if table.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES:
        table = F.broadcast(table)
    name = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source", name.alias("name"))
    rows = numbered(rows).join(table, F.col("source").eqNullSafe(F.col("of")))

    def drawn(acc: Column, part: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), part.cast("string"), F.col("name")).cast("binary")), 1, 13)
        u = F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))
        return acc + F.size(F.filter("cdf", lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(1), "parts"), F.lit(0), drawn)
    rows = rows.withColumn("copies", copies).where("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row", "name", "copy")
    dealt = rows.withColumn("place", F.xxhash64(F.lit(seed), "name", "copy"))
    return (dealt.repartition("place").sortWithinPartitions("place")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != copy], F.col("copy").alias(copy)))
