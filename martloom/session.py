"""Session settings the library is tuned for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Shuffles start in many partitions, which Spark then puts together by size. So the rows that one task sorts or groups
# stay about the same however large the tables are; with the number of cores as the number of partitions they would
# grow with the tables. The size is that of compressed rows, which take some ten times as much memory.
BY_SIZE = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # A small table leaves most of so many partitions empty and is still to be sent around.
    "spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin": "0",
}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **BY_SIZE,
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Counter state grows with the keys: keep it on disk, not in the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a job are deleted when the job ends, not when the driver next collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` holds further ``spark.*`` options."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
