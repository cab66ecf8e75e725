"""Label maps as orderable series keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_key(labels: Column) -> Column:
    """Deterministic text key of a label map: JSON of its key-sorted entries.

    MAP columns cannot be sorted or compared across engines; the key can.
    """
    entries = F.array_sort(F.map_entries(labels))
    return F.coalesce(
        F.to_json(F.map_from_entries(entries)), F.lit("{}")
    )
