"""Calendar expressions and day, year and week filters that reach the Parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.keys import as_column


def as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def previous_day(day: str | dt.date) -> dt.date:
    return as_date(day) - dt.timedelta(days=1)


def since_year(ts: str | Column, year: int) -> Column:
    """``year(ts) >= year`` written as a bound on the column itself, so that it is pushed down."""
    return as_column(ts) >= F.lit(dt.date(year, 1, 1))


def on_day(ts: str | Column, day: str | dt.date | None) -> Column:
    """Rows of one day as a half-open range; without a day every row (a backfill)."""
    if day is None:
        return F.lit(True)
    first = as_date(day)
    c = as_column(ts)
    return (c >= F.lit(first)) & (c < F.lit(first + dt.timedelta(days=1)))


def iso_week(ts: str | Column) -> Column:
    return F.weekofyear(as_column(ts))


def iso_year(ts: str | Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_column(ts))


def iso_week_label(ts: str | Column) -> Column:
    """ISO week as text, for example ``2021-W01``."""
    week = F.lpad(iso_week(ts).cast("string"), 2, "0")
    return F.concat(F.lpad(iso_year(ts).cast("string"), 4, "0"), F.lit("-W"), week)


def whole_days(end: str | Column, start: str | Column) -> Column:
    """Full days between two instants, cut towards zero (not calendar days)."""
    return F.date_part(F.lit("DAY"), as_column(end) - as_column(start)).cast("int")


def local_time(ts: str | Column, zone: str | Column) -> Column:
    """UTC instant as wall-clock time in ``zone``, a zone name or a column of names."""
    return F.from_utc_timestamp(as_column(ts), zone)
