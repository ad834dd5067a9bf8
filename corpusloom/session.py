"""Session settings the operators are tuned for.

Nothing here is required: the operators work on any session.  The builder only
names the settings that matter on a large cluster, where the caller passes
master, memory and ``spark.checkpoint.dir`` through ``spark-submit``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Run-time re-planning: partition coalescing and splitting of skewed joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Text scans fan out into many more bytes (tokens) than they read.
    "spark.sql.files.maxPartitionBytes": "64m",
    # Timestamps are compared as wall-clock values.
    "spark.sql.session.timeZone": "UTC",
    # Streaming key state lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def builder(app: str = "corpusloom") -> SparkSession.Builder:
    """A session builder with the settings above."""
    made = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made
