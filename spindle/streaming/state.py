"""What stateful processors need: the state store that offers timers and typed state variables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def timed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which is what ``transformWithState`` asks for; the
    caller's setting comes back afterwards (a query copies the settings when it starts)."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
