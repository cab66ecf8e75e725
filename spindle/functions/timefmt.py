"""Timestamp text and time-bucket expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: extended ISO-8601 as accepted by Python 3.11+ fromisoformat,
# restricted to 'T' or space between date and time.
ISO_TEXT_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
ISO_OUT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def strict_iso_timestamp(text: Column) -> Column:
    """TIMESTAMP of ISO text, NULL when the text is not strict ISO-8601.

    ``try_cast`` alone also accepts '2025', '2025-2-1', 'T12:00', leading
    blanks and zone names; the pattern rules those out, the cast rules out
    impossible dates and times. Naive text is read in the session zone (UTC).
    """
    ok = text.rlike(ISO_TEXT_PATTERN) & ~text.startswith("0000")
    return F.when(ok, text.try_cast("timestamp"))


def iso_text(ts: Column) -> Column:
    """ISO text with microseconds and a Z suffix (UTC)."""
    return F.concat(F.date_format(ts, ISO_OUT_FORMAT), F.lit("Z"))


def to_naive(ts: Column) -> Column:
    """Result timestamps are emitted as TIMESTAMP_NTZ in UTC wall time."""
    return ts.cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000.0)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds end - start with microsecond precision."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(
        1_000_000.0
    )


def bucket_start(ts: Column, period_s: Column | int) -> Column:
    """Start of the fixed ``period_s`` bucket holding ``ts`` (epoch aligned).

    Works with a per-row period (rules with different alignment periods),
    which the ``window`` function does not.
    """
    period = F.lit(period_s) if isinstance(period_s, int) else period_s
    micros = F.unix_micros(ts.cast("timestamp"))
    step = period.cast("long") * F.lit(1_000_000)
    return F.timestamp_micros(micros - F.pmod(micros, step))
