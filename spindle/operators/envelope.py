"""Message envelope: parse, validate, conform to the table schema, enforce REQUIRED.

All steps are column expressions over one row, so a chain of them compiles to
a single whole-stage-codegen Project/Filter and runs the same way on a batch
DataFrame and on a streaming one.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.jsonfn import (
    get, in_wrapper, is_object_text, wrap_parse, wrapped_ok,
)
from spindle.functions.timefmt import strict_iso_timestamp

# Required envelope keys and metadata keys.
REQUIRED_FIELDS = ("event_id", "timestamp", "data", "metadata")
METADATA_FIELDS = ("source", "version")

# Reject reasons in order of precedence (first match wins);
# the last one is raised by the sink's REQUIRED columns after validation.
REJECT_REASONS = (
    "invalid_utf8",
    "json_syntax",
    "not_object",
    "missing_fields",
    "bad_timestamp",
    "metadata_not_object",
    "metadata_missing_fields",
    "required_null",
)

# Error stage of each reason (counter families of the monitoring config).
REASON_STAGE = {
    "invalid_utf8": "parsing",
    "json_syntax": "parsing",
    "not_object": "parsing",
    "missing_fields": "validation",
    "bad_timestamp": "validation",
    "metadata_not_object": "validation",
    "metadata_missing_fields": "validation",
    "required_null": "storage",
    "cast_failed": "storage",
    "processing_error": "processing",
}

_TEXT, _UTF8, _OK, _DOC, _TS, _META = "_text", "_utf8_ok", "_parsed", "_doc", "_ts", "_meta"
_observe_ids = itertools.count()


def doc_get(keys: tuple[str, ...] | str, type_: str) -> Column:
    """Field of the parsed message (after ``parse``), e.g. for extra rules.

    NULL unless the whole text parsed as one JSON value.
    """
    return F.when(F.col(_OK), in_wrapper(F.col(_DOC), keys, type_))


def has(*keys: str) -> Column:
    """Key presence in the parsed message; a JSON null value counts as present."""
    return doc_get(tuple(keys), "variant").isNotNull()


def parsed_object() -> Column:
    """The message is valid UTF-8, one JSON value, and that value is an object."""
    return F.col(_UTF8) & F.col(_OK) & is_object_text(F.col(_TEXT))


def parse(messages: DataFrame, value_col: str = "value",
          time_col: str = "publish_time", observe_as: str | None = None) -> DataFrame:
    """Decode UTF-8, parse strict JSON once, stamp ``processing_timestamp``.

    ``processing_timestamp`` is the element time of the message (its publish
    time), never the wall clock, so re-running a job gives the same rows.
    """
    value = F.col(value_col)
    text = value.cast("string")
    parsed = (
        messages
        .withColumn(_TEXT, text)
        .withColumn(_UTF8, F.is_valid_utf8(F.col(_TEXT)))
        # _doc is the strict-parse array; the value is read in place as its
        # first element (copying it out would cost a second parse).
        .withColumn(_DOC, F.when(F.col(_UTF8), wrap_parse(F.col(_TEXT))))
        .withColumn(_OK, wrapped_ok(F.col(_DOC), F.col(_TEXT)))
        .withColumn("processing_timestamp", F.col(time_col).cast("timestamp"))
    )
    # Barrier + parse counters: filters on the parsed columns stay above it.
    return parsed.observe(
        observe_as or f"parse_{next(_observe_ids)}",
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col(_UTF8)).alias("invalid_utf8"),
        F.count_if(~F.col(_OK)).alias("unparsed"),
    )


def validation_reason(extra_rules: Sequence[tuple[str, Column]] = ()) -> Column:
    """Ordered CASE over the parsed columns; NULL means the message is valid.

    ``extra_rules`` are (reason, failing-condition) pairs appended after the
    built-in checks, the hook for user validation rules.
    """
    all_keys = F.lit(True)
    for k in REQUIRED_FIELDS:
        all_keys = all_keys & has(k)
    meta_keys = F.lit(True)
    for k in METADATA_FIELDS:
        meta_keys = meta_keys & has("metadata", k)
    chain = (
        F.when(~F.col(_UTF8), F.lit("invalid_utf8"))
        .when(~F.col(_OK), F.lit("json_syntax"))
        .when(~is_object_text(F.col(_TEXT)), F.lit("not_object"))
        .when(~all_keys, F.lit("missing_fields"))
        .when(F.col(_TS).isNull(), F.lit("bad_timestamp"))
        .when(F.col(_META).isNull(), F.lit("metadata_not_object"))
        .when(~meta_keys, F.lit("metadata_missing_fields"))
    )
    for reason, failing in extra_rules:
        chain = chain.when(failing, F.lit(reason))
    return chain


def classify(parsed: DataFrame, extra_rules: Sequence[tuple[str, Column]] = (),
             observe_as: str | None = None) -> DataFrame:
    """Add ``reject_reason`` (validator semantics; NULL = passes).

    The result passes through ``observe``: it publishes the received / valid
    / rejected counters of every batch or micro-batch (``observedMetrics`` of
    a streaming query), and, as Catalyst does not push filters through it,
    a later ``reject_reason`` filter cannot inline and re-run the JSON parse.
    """
    classified = (
        parsed
        .withColumn(_TS, strict_iso_timestamp(doc_get("timestamp", "string")))
        # NULL unless metadata is a JSON object; the copy is of metadata only.
        .withColumn(_META, doc_get("metadata", "map<string,variant>"))
        .withColumn("reject_reason", validation_reason(extra_rules))
    )
    name = observe_as or f"envelope_{next(_observe_ids)}"
    reason = F.col("reject_reason")
    return classified.observe(
        name,
        F.count(F.lit(1)).alias("received"),
        F.count_if(reason.isNull()).alias("valid"),
        F.count_if(reason.isNotNull()).alias("rejected"),
    )


def conform(classified: DataFrame) -> DataFrame:
    """Project the typed envelope columns of the landed table."""
    return (
        classified
        .withColumn("event_id", doc_get("event_id", "string"))
        .withColumn("timestamp", F.col(_TS))
        .withColumn("data", doc_get("data", "variant"))
        .withColumn("metadata", F.struct(
            doc_get(("metadata", "source"), "string").alias("source"),
            doc_get(("metadata", "version"), "string").alias("version"),
        ))
    )


def required_error(data_col: str = "data") -> Column:
    """Name of the first REQUIRED column that is NULL (JSON null counts), else NULL."""
    data = F.col(data_col)
    return (
        F.when(F.col("event_id").isNull(), F.lit("event_id"))
        .when(F.col("timestamp").isNull(), F.lit("timestamp"))
        .when(F.col("processing_timestamp").isNull(), F.lit("processing_timestamp"))
        .when(data.isNull() | F.is_variant_null(data), F.lit("data"))
        .when(F.col("metadata.source").isNull(), F.lit("metadata.source"))
        .when(F.col("metadata.version").isNull(), F.lit("metadata.version"))
    )


def enforce_required(conformed: DataFrame) -> DataFrame:
    """Sink-side REQUIRED check: valid rows with a NULL required field are rejected."""
    err = F.when(F.col("reject_reason").isNull(), required_error())
    return (
        conformed
        .withColumn("error_field", err)
        .withColumn("reject_reason", F.coalesce(
            F.col("reject_reason"), F.when(F.col("error_field").isNotNull(), F.lit("required_null"))
        ))
    )


def outcomes(messages: DataFrame, extra_rules: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Every message with its envelope columns and final ``reject_reason``.

    One narrow pass; the landed and reject tables are two filters of it.
    """
    return enforce_required(conform(classify(parse(messages), extra_rules)))


LANDED_COLUMNS = ("event_id", "timestamp", "processing_timestamp", "data", "metadata", "attributes")


def sink_columns(outcome_df: DataFrame) -> DataFrame:
    """Only what the landed and reject sinks write (drops the parse
    intermediates), e.g. before persisting one micro-batch for both sinks."""
    keep = [*LANDED_COLUMNS, "reject_reason", "error_field", "message_id", "publish_time", _TEXT]
    return outcome_df.select(*dict.fromkeys(keep))


def landed(outcome_df: DataFrame) -> DataFrame:
    return outcome_df.where(F.col("reject_reason").isNull()).select(*LANDED_COLUMNS)


def rejects(outcome_df: DataFrame) -> DataFrame:
    return outcome_df.where(F.col("reject_reason").isNotNull()).select(
        F.col(_TEXT).alias("value"), "reject_reason", "error_field", "event_id",
        "message_id", "publish_time", "attributes",
    )


def apply_transforms(messages: DataFrame) -> DataFrame:
    """Parse then validate, keeping valid messages only (validator filter semantics)."""
    return classify(parse(messages)).where(F.col("reject_reason").isNull())


def conform_flat(landed_df: DataFrame) -> DataFrame:
    """Flat table form: ``data`` as JSON text, no metadata column."""
    return landed_df.select(
        "event_id", "timestamp", F.to_json(F.col("data")).alias("data"), "processing_timestamp"
    )


def data_struct(landed_df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Typed projection of ``data`` leaves, e.g. {"key1": "string"}."""
    return landed_df.withColumn(
        "data",
        F.struct(*[get(F.col("data"), k, t).alias(k) for k, t in fields.items()]),
    )


def stage_of(reason: Column) -> Column:
    expr = None
    for r, stage in REASON_STAGE.items():
        expr = (F.when(reason == r, F.lit(stage)) if expr is None
                else expr.when(reason == r, F.lit(stage)))
    return expr.otherwise(F.lit("processing"))

