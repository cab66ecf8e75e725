"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

# SQL settings every operator assumes. They are session scoped, so callers
# that receive a session from elsewhere apply them with ``configure``.
SQL_CONF = {
    # Naive ISO text and naive driver timestamps are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object with a repeated key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # map_concat(base, fields): the right-hand map wins on a key clash.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "spindle", cores: str = "*", partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; production passes its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    The cluster names it in ``spark.checkpoint.dir``; only when the session
    has none is a fallback installed: the given folder (tests), else a
    folder under the session's warehouse location. That location is a local
    folder by default, so outside local masters a fallback on the local file
    system is refused.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the context
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        root = fallback or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        local = root.startswith("file:") or "://" not in root
        if local and not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: write ``df`` once to the shared checkpoint folder and
    read it back with its lineage cut. Used for intermediates that several
    branches of a plan read (so the source is not scanned again per branch)
    and that survive executor loss (never ``localCheckpoint``)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stream_checkpoint(spark: SparkSession, name: str, sink: str) -> str:
    """Default checkpoint of a stream: one folder per name and sink."""
    return f"{checkpoint_root(spark)}/{name}-{hashlib.md5(sink.encode()).hexdigest()[:12]}"
