"""spindle: event ingest and pipeline analytics expressed as Spark DataFrame plans.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, so the same code runs in batch and in Structured
Streaming and is planned by Catalyst.
"""

__version__ = "0.1.0"
