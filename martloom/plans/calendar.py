"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.dates import iso_week, iso_week_label


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``; ``date_id`` is the day as yyyymmdd."""
    return _rows(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def calendar_of(df: DataFrame, ts: str) -> DataFrame:
    """Calendar from the first to the last day of a timestamp column."""
    return _rows(df.agg(F.to_date(F.min(ts)).alias("start"), F.to_date(F.max(ts)).alias("end")))


def _rows(span: DataFrame) -> DataFrame:
    days = span.select(F.explode(F.sequence("start", "end")).alias("date_actual"))
    return days.select(
        F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_id"),
        "date_actual",
        iso_week("date_actual").alias("week_of_year"),
        iso_week_label("date_actual").alias("week_of_year_iso"),
    )
