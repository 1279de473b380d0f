"""Runs of consecutive days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def consecutive_day_runs(
    df: DataFrame, keys: Sequence[str], date: str, latest: str | None = None
) -> DataFrame:
    """One row per unbroken run of days per key: ``run_start``, ``run_end``, ``count_days``.

    Rows are reduced to distinct days before the window, so a group holds at most one row per
    calendar day however many events a key has. ``latest`` names a column (a struct, say) whose
    largest value is kept per run.
    """
    kept = [] if latest is None else [F.max(latest).alias(latest)]
    day = F.to_date(date).alias("_day")
    dated = df.where(F.col(date).isNotNull())
    days = dated.groupBy(*keys, day).agg(*kept) if kept else dated.select(*keys, day).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_day"))
    return (
        days.withColumn("_anchor", F.date_sub("_day", rank))
        .groupBy(*keys, "_anchor")
        .agg(
            F.min("_day").alias("run_start"),
            F.max("_day").alias("run_end"),
            F.count(F.lit(1)).alias("count_days"),
            *kept,
        )
        .drop("_anchor")
    )
