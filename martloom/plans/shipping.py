"""Shipping log to reference tables, shipment tables and the shipping mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import whole_days
from martloom.functions.text import packed_field
from martloom.operators.lineage import cut_lineage
from martloom.operators.loads import surrogate_id

RATE = "decimal(14,3)"

# Columns of the log that describe a shipment's terms.
DESCRIPTIONS = (
    "shipping_country",
    "shipping_country_base_rate",
    "vendor_agreement_description",
    "shipping_transfer_description",
    "shipping_transfer_rate",
)

# State and status texts as the log spells them.
RECEIVED = "recieved"
RETURNED = "returned"
FINISHED = "finished"


def shipping_country_rates(log: DataFrame) -> DataFrame:
    """Distinct country and base rate with a serial id."""
    pairs = log.select("shipping_country", "shipping_country_base_rate").distinct()
    return surrogate_id(pairs, ["shipping_country", "shipping_country_base_rate"])


def shipping_agreement(log: DataFrame) -> DataFrame:
    """Agreements unpacked from ``id:number:rate:commission``; distinct texts are unpacked once."""
    packed = log.select("vendor_agreement_description").distinct()

    def field(position: int) -> Column:
        return packed_field("vendor_agreement_description", position)

    return packed.select(
        field(1).cast("long").alias("agreement_id"),
        field(2).alias("agreement_number"),
        field(3).cast(RATE).alias("agreement_rate"),
        field(4).cast(RATE).alias("agreement_commission"),
    ).distinct()


def shipping_transfer(log: DataFrame) -> DataFrame:
    """Transfer types unpacked from ``type:model`` beside their rate, with a serial id."""
    packed = log.select("shipping_transfer_description", "shipping_transfer_rate").distinct()
    fields = packed.select(
        packed_field("shipping_transfer_description", 1).alias("transfer_type"),
        packed_field("shipping_transfer_description", 2).alias("transfer_model"),
        "shipping_transfer_rate",
    ).distinct()
    return surrogate_id(fields, ["transfer_type", "transfer_model", "shipping_transfer_rate"])


def shipping_references(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Country rates, agreements and transfers of a log that is read once for all three.

    The few different descriptions are kept at a checkpoint, so that neither the serial ids nor whoever joins these
    tables goes back to the log.
    """
    described = cut_lineage(log.select(*DESCRIPTIONS).distinct())
    tables = shipping_country_rates(described), shipping_agreement(described), shipping_transfer(described)
    rates, agreements, transfers = (cut_lineage(table) for table in tables)
    return rates, agreements, transfers


def shipping_info(log: DataFrame, rates: DataFrame, agreements: DataFrame, transfers: DataFrame) -> DataFrame:
    """One row per shipment with the ids of its country rate, agreement and transfer.

    The log holds a row per state. The lookups replace its texts by ids first, so the one
    shuffle, that of the distinct, carries ids only. Rates are part of the country and transfer
    lookups: a name with two rates does not multiply shipments; an agreement of several versions is looked up once.
    """
    rows = log.withColumn("agreement_id", packed_field("vendor_agreement_description", 1).cast("long"))
    country = rates.select(
        F.col("id").alias("shipping_country_rate_id"),
        F.col("shipping_country").alias("_country"),
        F.col("shipping_country_base_rate").alias("_country_rate"),
    )
    agreement = agreements.select(F.col("agreement_id").alias("shipping_agreement_id")).distinct()
    transfer = transfers.select(
        F.col("id").alias("shipping_transfer_id"),
        F.concat_ws(":", "transfer_type", "transfer_model").alias("_transfer"),
        F.col("shipping_transfer_rate").alias("_transfer_rate"),
    )
    return (
        rows.join(
            country,
            (F.col("shipping_country") == F.col("_country"))
            & F.col("shipping_country_base_rate").eqNullSafe(F.col("_country_rate")),
            "left",
        )
        .join(agreement, F.col("agreement_id") == F.col("shipping_agreement_id"))
        .join(
            transfer,
            (F.col("shipping_transfer_description") == F.col("_transfer"))
            & F.col("shipping_transfer_rate").eqNullSafe(F.col("_transfer_rate")),
        )
        .select(
            "shipping_id",
            "payment_amount",
            "vendor_id",
            "shipping_plan_datetime",
            "shipping_country_rate_id",
            "shipping_agreement_id",
            "shipping_transfer_id",
        )
        .distinct()
    )


def shipping_status(
    log: DataFrame, final_states: Sequence[str] = (RECEIVED, RETURNED), returned: str = RETURNED
) -> DataFrame:
    """Latest status and state per shipment with its first and last time, in one aggregation.

    Rows in the ``returned`` state do not count for the first and last time, and a shipment with
    only such rows is left out. The last time is given once the latest state is final. Rows at
    the same time are ordered by ``id``.
    """
    moving = F.col("state") != returned
    return (
        log.groupBy("shipping_id")
        .agg(
            F.max_by(F.struct("status", "state"), F.struct("state_datetime", "id")).alias("_latest"),
            F.min(F.when(moving, F.col("state_datetime"))).alias("shipping_start_fact_datetime"),
            F.max(F.when(moving, F.col("state_datetime"))).alias("_finish"),
            F.count_if(moving).alias("_moving"),
        )
        .where("_moving > 0")
        .select(
            "shipping_id",
            "_latest.status",
            "_latest.state",
            "shipping_start_fact_datetime",
            F.when(F.col("_latest.state").isin(*final_states), F.col("_finish")).alias("shipping_end_fact_datetime"),
        )
    )


def shipping_datamart(
    info: DataFrame,
    transfers: DataFrame,
    status: DataFrame,
    agreements: DataFrame,
    rates: DataFrame,
    as_of: object,
    finished: str = FINISHED,
) -> DataFrame:
    """Days on the way, delay, vat and profit per shipment; open shipments end at ``as_of``."""
    start, end, plan = "shipping_start_fact_datetime", "_end", "shipping_plan_datetime"
    late = F.col(end) > F.col(plan)
    total_rate = F.col("shipping_country_base_rate") + F.col("agreement_rate") + F.col("shipping_transfer_rate")
    times = status.withColumn(end, F.coalesce("shipping_end_fact_datetime", F.lit(as_of)))
    return (
        info.join(times, "shipping_id")
        .join(transfers.withColumnRenamed("id", "shipping_transfer_id"), "shipping_transfer_id")
        .join(agreements.withColumnRenamed("agreement_id", "shipping_agreement_id"), "shipping_agreement_id")
        .join(rates.withColumnRenamed("id", "shipping_country_rate_id"), "shipping_country_rate_id")
        .select(
            "shipping_id",
            "vendor_id",
            "transfer_type",
            whole_days(end, start).alias("full_day_at_shipping"),
            F.coalesce(late, F.lit(False)).alias("is_delay"),
            F.coalesce(F.col("status") == finished, F.lit(False)).alias("is_shipping_finish"),
            F.when(late, whole_days(end, plan)).otherwise(0).alias("delay_day_at_shipping"),
            "payment_amount",
            (F.col("payment_amount") * total_rate).cast(RATE).alias("vat"),
            (F.col("payment_amount") * F.col("agreement_commission")).cast(RATE).alias("profit"),
        )
        .distinct()
    )
