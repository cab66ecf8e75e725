"""Publishing: rows -> broker messages (JSON bytes, attributes, ordering key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.schemas import MESSAGE


def encode_json(payload: Column, keep_nulls: bool = True) -> Column:
    """UTF-8 bytes of the JSON text of a struct/map/variant column."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.encode(F.to_json(payload, opts), "UTF-8")


def publish(df: DataFrame, payload: Column, message_id: Column, publish_time: Column,
            ordering_key: Column | None = None, attributes: Column | None = None) -> DataFrame:
    """Project rows to the broker message schema, the payload serialised as JSON.

    Ordering key and attributes are independent options. Writing the result to
    Kafka (``key`` = ordering key, ``headers`` = attributes) or to files is a
    plain ``write``/``writeStream`` of this frame.
    """
    return publish_bytes(df, encode_json(payload), message_id, publish_time,
                         ordering_key, attributes)


def publish_bytes(df: DataFrame, value: Column, message_id: Column, publish_time: Column,
                  ordering_key: Column | None = None,
                  attributes: Column | None = None) -> DataFrame:
    """Same projection for a payload that is already bytes."""
    return df.select(
        value.cast("binary").alias("value"),
        (attributes if attributes is not None
         else F.create_map().cast("map<string,string>")).alias("attributes"),
        (ordering_key if ordering_key is not None else F.lit(None).cast("string")).alias("ordering_key"),
        message_id.cast("string").alias("message_id"),
        publish_time.cast("timestamp").alias("publish_time"),
    )


def to_kafka_frame(messages: DataFrame) -> DataFrame:
    """Kafka sink columns: key (ordering key), value, headers (attributes)."""
    headers = F.transform(
        F.map_entries("attributes"),
        lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")),
    )
    return messages.select(
        F.encode("ordering_key", "UTF-8").alias("key"), "value", headers.alias("headers")
    )


def ordered_by_key(messages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per-key ordered delivery in batch form: all messages of a key in one
    partition, sorted by publish time within it."""
    parts = messages.repartition(partitions, "ordering_key") if partitions else \
        messages.repartition("ordering_key")
    return parts.sortWithinPartitions("ordering_key", "publish_time")


def write_messages(messages: DataFrame, path: str, max_records_per_file: int | None = None,
                   mode: str = "append") -> None:
    """Batch publish to a file-based topic; ``max_records_per_file`` bounds a
    publish batch by count (a streaming writer bounds it by trigger interval)."""
    writer = messages.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(path)


def start_publish(messages: DataFrame, path: str, checkpoint: str,
                  processing_time: str | None = None, available_now: bool = False):
    """Streaming publish to a file-based topic (the Kafka form writes
    ``to_kafka_frame(messages)`` with ``format("kafka")``)."""
    w = (messages.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
