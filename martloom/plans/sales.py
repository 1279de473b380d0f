"""Daily sales increments: staging, dimensions, fact and weekly retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_date, iso_week_label, on_day
from martloom.operators.loads import ensure_column, new_rows
from martloom.operators.ranking import first_per_key

# Status of a plain sale (also the default of older files) and of a refund.
SHIPPED = "shipped"
REFUNDED = "refunded"


def clean_increment(raw: DataFrame, order_by: Sequence[Column], key: str = "uniq_id") -> DataFrame:
    """One row per ``uniq_id`` without the file's own ``id``; ``status`` defaults to shipped.

    Files have no fixed row order on a cluster, so the row kept is the first by ``order_by``.
    """
    rows = first_per_key(raw, [key], order_by).drop("id")
    return ensure_column(rows, "status", "string", SHIPPED)


def new_dimension_rows(
    stg: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str], latest_by: Sequence[str]
) -> DataFrame:
    """New dimension rows: one per key the dimension lacks, with its latest attributes.

    The staging rows are reduced to keys before they meet the dimension, so a hot key is one row
    by then.
    """
    latest = F.max_by(F.struct(*attrs), F.struct(*latest_by, *attrs)).alias("_attrs")
    per_key = stg.groupBy(key).agg(latest).select(key, *[F.col(f"_attrs.{a}") for a in attrs])
    return new_rows(per_key, dim, [key])


def new_customer_rows(stg: DataFrame, dim: DataFrame, latest_by: Sequence[str]) -> DataFrame:
    """New customers with their latest name and highest ``city_id``."""
    names = ["first_name", "last_name"]
    per_key = stg.groupBy("customer_id").agg(
        F.max_by(F.struct(*names), F.struct(*latest_by, *names)).alias("_names"), F.max("city_id").alias("city_id")
    )
    rows = per_key.select("customer_id", *[F.col(f"_names.{n}") for n in names], "city_id")
    return new_rows(rows, dim, ["customer_id"])


def sales_fact(stg: DataFrame, calendar: DataFrame, ds: str | dt.date | None = None) -> DataFrame:
    """Sales of one day, or of all days, with the calendar's date id.

    Anything but a plain sale counts negative.
    """
    dates = calendar.select("date_id", "date_actual")
    day = stg.where(on_day("date_time", ds))
    amount = F.col("payment_amount")
    return day.join(dates, F.to_date("date_time") == F.col("date_actual"), "left").select(
        "date_id",
        "item_id",
        "customer_id",
        "city_id",
        "quantity",
        F.when(F.col("status") == SHIPPED, amount).otherwise(-amount).alias("payment_amount"),
        "status",
    )


def customer_retention(sales: DataFrame, calendar: DataFrame, ds: str | dt.date | None = None) -> DataFrame:
    """Retention per item of the ISO week that holds ``ds``, or of every week.

    A customer is new in a week with exactly one sale of the item and returning with more; this
    looks at the week alone, not at the customer's past. Refunded revenue keeps the negative
    sign it has in the fact. Load the result with ``replace_period`` on the week.
    """
    dates = calendar.select(
        "date_id", F.col("week_of_year_iso").alias("period_name"), F.col("week_of_year").alias("period_id")
    )
    if ds is not None:
        dates = dates.where(F.col("period_name") == iso_week_label(F.lit(as_date(ds))))
    per_customer = (
        sales.join(dates, "date_id")
        .groupBy("customer_id", "period_name", "period_id", "status", "item_id")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("payment_amount").alias("revenue"))
    )
    refunded = F.col("status") == REFUNDED
    kinds = {
        "new": (F.col("orders") == 1) & ~refunded,
        "returning": (F.col("orders") > 1) & ~refunded,
        "refunded": refunded,
    }

    def revenue(kind: str) -> Column:
        return F.sum(F.when(kinds[kind], F.col("revenue")).otherwise(F.lit(0)))

    return per_customer.groupBy("period_name", "period_id", "item_id").agg(
        F.count_if(kinds["new"]).alias("new_customers_count"),
        F.count_if(kinds["returning"]).alias("returning_customers_count"),
        F.count_if(kinds["refunded"]).alias("refunded_customer_count"),
        revenue("new").alias("new_customers_revenue"),
        revenue("returning").alias("returning_customers_revenue"),
        revenue("refunded").alias("customers_refunded"),
    )
