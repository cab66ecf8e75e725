"""Structured log rows for rejected messages (set-based, one row per reject)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.functions.timefmt import iso_text

# Log message per reject reason.
REASON_MESSAGE = {
    "invalid_utf8": "Error processing message",
    "json_syntax": "Failed to parse JSON message",
    "not_object": "Error processing message",
    "missing_fields": "Message missing required fields",
    "bad_timestamp": "Invalid timestamp format",
    "metadata_not_object": "Metadata must be a dictionary",
    "metadata_missing_fields": "Metadata missing required fields: source, version",
    "required_null": "Required field is null",
}


def reason_message(reason):
    expr = None
    for r, msg in REASON_MESSAGE.items():
        expr = F.when(reason == r, F.lit(msg)) if expr is None else expr.when(reason == r, F.lit(msg))
    return expr.otherwise(F.lit("Error validating message"))


def log_rows(rejects: DataFrame, logger: str = "spindle.ingest", severity: str = "ERROR",
             time_col: str = "publish_time", fields: dict | None = None) -> DataFrame:
    """Message, severity, timestamp (UTC, Z), logger + caller fields.

    ``fields`` (name -> Column or value) are merged over the fixed fields:
    a caller field with a fixed name wins (map_concat under the LAST_WIN
    dedup policy); ``log`` is the JSON line.
    """
    base = F.create_map(
        F.lit("message"), reason_message(F.col("reject_reason")),
        F.lit("severity"), F.lit(severity),
        F.lit("timestamp"), iso_text(F.col(time_col)),
        F.lit("logger"), F.lit(logger),
    )
    extra = [F.lit("reason"), F.col("reject_reason"), F.lit("message_id"), F.col("message_id")]
    for k, v in (fields or {}).items():
        extra += [F.lit(k), v.cast("string") if hasattr(v, "cast") else F.lit(str(v))]
    entry = F.map_concat(base, F.create_map(*extra))
    return rejects.select(
        entry["severity"].alias("severity"),
        F.lower(entry["severity"]).alias("level"),
        entry["message"].alias("message"),
        entry["logger"].alias("logger"),
        F.col("reject_reason").alias("reason"),
        "message_id",
        F.to_json(entry).alias("log"),
    )
