"""A store of landed rows for lookups and counts.

Three parts, written once from the landed rows:

* ``rows``: the landed rows in ranges of ``event_id``, sorted within files, with a Bloom filter
  on it. A lookup or a prefix opens the files whose least and greatest id leave it open, and of those the row groups
  that filter and statistics leave.
* ``moments``: (date, minute, timestamp, processed, event_id, batch_id) of every message that names a time, partitioned
  by date: what the edges of an interval are counted from. No payload.
* ``minutes``: per date and minute how many messages were sent and processed, and how many before that minute on
  its date (a running sum per date), and ``days``: the same per date over all earlier dates. The messages up to a
  moment are one row of each, so a count over any interval is a difference of two such sums plus the messages of the two
  minutes at its edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindle.session import checkpoint_root

ROWS, MOMENTS, MINUTES, DAYS = "rows", "moments", "minutes", "days"
MINUTE = 60


def write_rows(landed: DataFrame, path: str, files: int | None = None, row_group: int = 16 << 20) -> None:
    """``files``: ranges of the id; by default the session's shuffle partitions."""
    ranged = landed.repartitionByRange(*([files] if files else []), "event_id").sortWithinPartitions("event_id", "timestamp")
    (ranged.write.option("parquet.bloom.filter.enabled#event_id", "true")
     .option("parquet.block.size", str(row_group)).mode("overwrite").parquet(f"{path}/{ROWS}"))


def write_counts(outcomes: DataFrame, path: str) -> None:
    """From (event_id, timestamp, processing_timestamp or NULL, batch_id) of every message with a time."""
    t = F.unix_seconds("timestamp")
    moments = outcomes.where("timestamp IS NOT NULL").select(
        F.to_date("timestamp").alias("date"), F.floor(t / MINUTE).cast("long").alias("minute"), "timestamp",
        F.col("processing_timestamp").isNotNull().alias("processed"), "event_id", "batch_id")
    moments.write.mode("overwrite").partitionBy("date").parquet(f"{path}/{MOMENTS}")
    spark = outcomes.sparkSession
    per = (spark.read.parquet(f"{path}/{MOMENTS}").groupBy("date", "minute")
           .agg(F.count(F.lit(1)).alias("sent"), F.count_if("processed").alias("processed")))
    before = Window.partitionBy("date").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("sent", "processed")})
    # 1,440 short rows a date at most: a date fits a file.
    per.repartition("date").write.mode("overwrite").partitionBy("date").parquet(f"{path}/{MINUTES}")
    days = spark.read.parquet(f"{path}/{MINUTES}").groupBy("date").agg(F.sum("sent").alias("sent"), F.sum("processed").alias("processed"))
    # One row per date.
    before = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    (days.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("sent", "processed")})
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/{DAYS}"))


def read(spark: SparkSession, path: str, part: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{part}")


def lookup(spark: SparkSession, path: str, event_id: str) -> DataFrame:
    """All rows of one id."""
    return read(spark, path, ROWS).where(F.col("event_id") == F.lit(event_id))


def with_prefix(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """All rows whose id begins with ``prefix``."""
    return read(spark, path, ROWS).where(F.col("event_id").startswith(prefix))


def _moment(at: Column | str) -> Column:
    return F.lit(at).cast("timestamp") if isinstance(at, str) else at


def _before(spark: SparkSession, path: str, at: Column) -> list[DataFrame]:
    """Rows of (sent, processed) whose sums lie before the minute of ``at``."""
    date, minute = F.to_date(at), F.floor(F.unix_seconds(at) / MINUTE)
    # All earlier dates: the sums up to the last of them; the date itself: those up to its last minute that is earlier.
    sums = [F.coalesce(F.max(F.col(c) + F.col(f"{c}_before")), F.lit(0)).alias(c) for c in ("sent", "processed")]
    return [read(spark, path, DAYS).where(F.col("date") < date).agg(*sums),
            read(spark, path, MINUTES).where((F.col("date") == date) & (F.col("minute") < minute)).agg(*sums)]


def count_between(spark: SparkSession, path: str, start: Column | str, end: Column | str | None = None) -> DataFrame:
    """(sent, processed) with ``start`` <= timestamp <= ``end``; without an end, all from ``start`` on."""
    lo = _moment(start)
    moments, t = read(spark, path, MOMENTS), F.col("timestamp")
    figures = [F.count(F.lit(1)).alias("sent"), F.count_if("processed").alias("processed")]

    def in_minute(at: Column, only: Column) -> DataFrame:
        here = (F.col("date") == F.to_date(at)) & (F.col("minute") == F.floor(F.unix_seconds(at) / MINUTE))
        return moments.where(here & only).agg(*figures)

    # What lies before start: the sums up to its minute, and that minute's earlier messages.
    signed = [(part, -1) for part in (*_before(spark, path, lo), in_minute(lo, t < lo))]
    if end is None:
        whole = read(spark, path, DAYS).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sent", "processed")])
        signed.append((whole, 1))
    else:
        hi = _moment(end)
        signed += [(part, 1) for part in (*_before(spark, path, hi), in_minute(hi, t <= hi))]
    parts = [df.select(*[(F.col(c) * sign).alias(c) for c in ("sent", "processed")]) for df, sign in signed]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.agg(*[F.greatest(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("sent", "processed")])


def at_path(spark: SparkSession, name: str) -> str:
    """Where a store of that name lies in the shared folder."""
    return f"{checkpoint_root(spark)}/store/{name}"
