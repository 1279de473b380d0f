"""Rows that count once without operator state: ids seen so far lie in a table by period, and late rows look there.

A message keeps its id and its time when it is sent again, so a batch reads only the ids of the periods its own rows
fall in: the current one as a rule, an old one for a late or replayed row. Nothing is kept in the state store, no
row is too late, and what the driver and the executors hold does not grow with the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.operators.loads import write_partitions
from martloom.operators.ranking import first_per_key
from martloom.plans.orders import user_counters
from martloom.streaming.compaction import FAN_IN, compact, part_paths, versions
from martloom.streaming.sinks import BatchSink, table_sink

UNDATED = "undated"


def first_seen(
    batch: DataFrame, batch_id: int, seen_path: str, id_col: str, ts_col: str, *, period: str = "day"
) -> DataFrame:
    """One row, the earliest, for each id of the batch that no earlier batch held; the ids are noted in ``seen_path``.

    ``period`` is a unit of ``date_trunc``. A batch that is run again gives the same rows: it does not look at what it
    has noted itself. Rows without an id are left out, rows without a time share a period of their own.
    """
    label = F.coalesce(F.date_format(F.date_trunc(period, F.col(ts_col)), "yyyyMMddHH"), F.lit(UNDATED))
    known_ids = batch.where(F.col(id_col).isNotNull()).withColumn("period", label)
    once = first_per_key(known_ids, [id_col], [F.col(ts_col).asc_nulls_last()])
    # As many as the batch has periods.
    periods = [row["period"] for row in once.select("period").distinct().collect()]
    spark = batch.sparkSession
    paths = [p for name in periods for p in part_paths(spark, f"{seen_path}/period={name}", before=batch_id)]
    if paths:
        ids = spark.read.schema(once.select(id_col).schema).parquet(*paths)
        once = once.join(ids, id_col, "left_anti")
    noted = once.select(id_col, "period", F.lit(batch_id).cast("long").alias("batch_id"))
    write_partitions(noted, seen_path, ["period", "batch_id"])
    return once.drop("period").select(*batch.columns)


def compact_seen(spark: SparkSession, seen_path: str, periods: Sequence[str], id_col: str, fan_in: int = FAN_IN) -> None:
    """Merge the notes of many batches in the given periods (``yyyyMMddHH``)."""
    for name in periods:
        compact(spark, f"{seen_path}/period={name}", [id_col], fan_in=fan_in)


def once_sink(seen_path: str, id_col: str, ts_col: str, deliver: BatchSink, *, period: str = "day") -> BatchSink:
    """A sink that hands on only rows whose id comes for the first time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            fresh = first_seen(kept, batch_id, seen_path, id_col, ts_col, period=period)
            deliver(fresh, batch_id)
        finally:
            kept.unpersist()

    return write


def counter_deltas_stream(
    items: DataFrame,
    item_key: str,
    item_name: str,
    path: str,
    checkpoint: str,
    *,
    ts_col: str,
    trigger: dict[str, object],
    period: str = "day",
) -> StreamingQuery:
    """Counters per user and item without operator state: every batch adds what it counts, ``current_counters`` sums.

    Repeats of an ``object_id`` count once whenever they come. A repeated batch replaces its own counts.
    """

    def deliver(fresh: DataFrame, batch_id: int) -> None:
        last = fresh.groupBy("user_id", item_key).agg(F.max(ts_col).alias("last_ts"))
        counts = user_counters(fresh, item_key, item_name, [ts_col])
        table_sink(path)(counts.join(last, ["user_id", item_key]), batch_id)

    sink = once_sink(f"{path.rstrip('/')}-seen", "object_id", ts_col, deliver, period=period)
    writer = items.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return writer.trigger(**trigger).start()


def _sums(rows: DataFrame, keys: Sequence[str], item_name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.max_by(item_name, F.struct("last_ts", item_name)).alias(item_name),
        F.sum("order_cnt").alias("order_cnt"),
        F.max("last_ts").alias("last_ts"),
        F.max("batch_id").alias("batch_id"),
    )


def compact_counters(spark: SparkSession, path: str, item_key: str, item_name: str, fan_in: int = FAN_IN) -> int:
    """Merge the counts of many batches into sums."""
    return compact(spark, path, ["user_id", item_key], fan_in=fan_in, merge=lambda rows, keys, _: _sums(rows, keys, item_name))


def current_counters(spark: SparkSession, path: str, item_key: str, item_name: str) -> DataFrame:
    """Counters of all batches, compacted or not."""
    summed = _sums(versions(spark, path), ["user_id", item_key], item_name)
    return summed.select("user_id", item_key, item_name, "order_cnt")
