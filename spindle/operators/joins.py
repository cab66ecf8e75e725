"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a small side that may be shipped to every executor.
DEFAULT_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when ``df`` is proven small; otherwise leave the
    choice to the planner (sort-merge / AQE).

    The check is a bounded count (``limit(max_rows + 1)``), so it stops
    early on a large input.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
