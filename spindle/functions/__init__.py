"""Column-expression helpers (pure Spark SQL expressions, no Python UDFs)."""

from spindle.functions.jsonfn import (
    get, in_wrapper, is_object_text, wrap_parse, wrapped_ok,
)
from spindle.functions.labels import series_key
from spindle.functions.timefmt import (
    bucket_start, epoch_seconds, iso_text, seconds_between, strict_iso_timestamp, to_naive,
)

__all__ = [
    "bucket_start", "epoch_seconds", "get", "in_wrapper",
    "is_object_text", "iso_text", "seconds_between", "series_key",
    "strict_iso_timestamp", "to_naive", "wrap_parse", "wrapped_ok",
]
