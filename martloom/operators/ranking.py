"""First and latest rows per key, top-k, and row numbers and buckets over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.keys import as_column
from martloom.operators.lineage import cut_lineage

# ``monotonically_increasing_id`` holds the task in the bits above these and the row below.
ROW_BITS = 33


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps only the first row per key and task before the shuffle, so a key that holds a
    large part of the rows costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the last by ``order_by``; end it in a unique column for a fixed result."""
    return first_per_key(df, keys, [as_column(c).desc_nulls_last() for c in order_by])


def top_k(df: DataFrame, k: int, order_by: Sequence[Column]) -> DataFrame:
    """The first k rows; each task keeps at most k."""
    return df.orderBy(*order_by).limit(k)


def _positions(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Sorted rows with the task that sorted them, ``_part``, and their place in it, ``_local``.

    A global sort cuts the keys into ranges by a sample and sorts each range in its own task, so
    tasks follow each other in key order. The checkpoint fixes the positions: a task lost later
    is read again, not sorted again into other ranges.
    """
    placed = cut_lineage(df.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()))
    return placed.select(
        *df.columns,
        F.shiftright("_id", ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND((1 << ROW_BITS) - 1).alias("_local"),
    )


def _offsets(placed: DataFrame) -> DataFrame:
    """Rows of each sorting task, rows before it and rows in all: one row per task."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            "_rows",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(everything).alias("_total"),
        )
    )


def global_row_number(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Row numbers 1..n over a whole table, ascending and NULLs first.

    The table is sorted in parallel, numbered in each task and shifted by the row count of the tasks before.
    """
    placed = _positions(df, order_by)
    # One row per sorting task: always small enough to send around.
    offsets = F.broadcast(_offsets(placed).select("_part", "_before"))
    return placed.join(offsets, "_part").select(*df.columns, (F.col("_before") + F.col("_local") + 1).alias(name))


def group_row_number(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """Row numbers 1..n within each group; a group of any size is sorted by many tasks.

    ``keys`` are never NULL. Rows are sorted by group and order in parallel and numbered in each task; the rows of the
    group in the tasks before shift the numbers.
    """
    placed = _positions(df, [*keys, *order_by])
    here = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_rows"), F.min("_local").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1
    shifts = here.select("_part", *keys, shift.alias("_shift"))
    return placed.join(shifts, ["_part", *keys]).select(*df.columns, (F.col("_local") + F.col("_shift")).alias(name))


def _bucket_ends(df: DataFrame, order_by: Sequence[str], buckets: int) -> DataFrame:
    """One row with the keys of the last row of every bucket but the final one."""
    placed = _positions(df, order_by)
    size, rest = F.floor(F.col("_total") / buckets), F.col("_total") % buckets
    last = F.col("_bucket") * size + F.least("_bucket", rest)
    wanted = (
        _offsets(placed)
        .withColumn("_bucket", F.explode(F.sequence(F.lit(1), F.lit(buckets - 1))))
        .withColumn("_local", last - F.col("_before") - 1)
        .where("_local >= 0 and _local < _rows")
        .select("_part", "_local")
    )
    # The key is repeated where buckets are empty: fewer rows than buckets.
    found = placed.join(F.broadcast(wanted), ["_part", "_local"])
    return found.agg(F.collect_list(F.struct(*order_by)).alias("ends"))


def global_ntile(df: DataFrame, scores: dict[str, str], key: str, buckets: int) -> DataFrame:
    """Adds ``ntile(buckets)`` over the whole table for each ``{new column: metric column}``.

    Ties are ordered by ``key``, which is unique. The rows never meet in one task: a parallel sort of metric and key
    gives the rows that end each bucket, and every row is then compared with these few where it lies.
    """
    df = cut_lineage(df)
    labelled = df
    for name, metric in scores.items():
        ends = _bucket_ends(df.select(metric, key), [metric, key], buckets)
        labelled = (
            labelled.withColumn("_key", F.struct(metric, key))
            .withColumn("_ends", ends.scalar())
            .withColumn(name, 1 + F.size(F.filter("_ends", lambda e: e < F.col("_key"))))
            .drop("_key", "_ends")
        )
    return labelled
