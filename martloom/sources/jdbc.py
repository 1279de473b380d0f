"""Database tables over JDBC. The driver jar and all options come from the caller."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from martloom.functions.dates import as_date, on_day


def read_table(spark: SparkSession, options: dict[str, str], table: str) -> DataFrame:
    """Snapshot of a table.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in the
    options for anything large; without them one task reads the table.
    """
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def extract_day(
    spark: SparkSession, options: dict[str, str], table: str, ts_col: str, ds: str | dt.date, slices: int = 24
) -> DataFrame:
    """Rows of one day, read in ``slices`` parallel ranges of the timestamp the database filters itself."""
    return spark.read.jdbc(
        options["url"], table, predicates=day_predicates(ts_col, ds, slices), properties=_properties(options)
    )


def day_predicates(ts_col: str, ds: str | dt.date, slices: int) -> list[str]:
    """Half-open ranges that cover the day once."""
    start = dt.datetime.combine(as_date(ds), dt.time())
    width = dt.timedelta(days=1)
    edges = [start + width * i / slices for i in range(slices + 1)]
    return [
        f"{ts_col} >= TIMESTAMP '{low:%Y-%m-%d %H:%M:%S.%f}' AND {ts_col} < TIMESTAMP '{high:%Y-%m-%d %H:%M:%S.%f}'"
        for low, high in zip(edges, edges[1:])
    ]


def day_rows(df: DataFrame, ts_col: str, ds: str | dt.date) -> DataFrame:
    """The same day filter for a table that is already a DataFrame."""
    return df.where(on_day(ts_col, ds))


def _properties(options: dict[str, str]) -> dict[str, str]:
    return {k: v for k, v in options.items() if k not in ("url", "dbtable")}


def append_table(df: DataFrame, options: dict[str, str], table: str) -> None:
    """Append rows to a database table."""
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
