"""Transactions and currency rates to a data vault and daily global metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import on_day
from martloom.functions.keys import md5_key
from martloom.operators.asof import asof_lookup, join_hot
from martloom.operators.vault import KeyFunction, load_hub, load_link, load_satellite

# Code of the currency amounts are converted to, and a transaction type left out.
BASE_CURRENCY = 420
AUTHORIZATION = "authorization"

# One day, or None for all days at once.
Day = str | dt.date | None


def hub_transactions(
    transactions: DataFrame, hub: DataFrame | None, day: Day, load_dt: object, source: str, key: KeyFunction = md5_key
) -> DataFrame:
    """Operations of the day; test accounts, which are negative, are skipped."""
    rows = transactions.where(on_day("transaction_dt", day) & (F.col("account_number_from") >= 0))
    return load_hub(rows, hub, "h_transaction_pk", ["operation_id"], load_dt, source, key=key)


def hub_currencies(
    currencies: DataFrame, hub: DataFrame | None, day: Day, load_dt: object, source: str, key: KeyFunction = md5_key
) -> DataFrame:
    """Currencies of the day, one hub row per code and update time."""
    rows = currencies.where(on_day("date_update", day))
    return load_hub(rows, hub, "h_currency_pk", ["currency_code", "date_update"], load_dt, source, key=key)


def _nearest_versions(asked: DataFrame, versions: DataFrame) -> DataFrame:
    """(currency_code, _day, h_currency_pk) for each asked currency and day: all versions of that day, or one other."""
    same = asked.join(versions, ["currency_code", "_day"])
    missed = asked.join(versions, ["currency_code", "_day"], "left_anti")
    known = versions.select("currency_code", "_day", F.col("h_currency_pk").alias("_before"))
    before = asof_lookup(missed, known, ["currency_code"], "_day", "_day", ["_before"], span="year")
    after = known.withColumnRenamed("_before", "_after")
    other = asof_lookup(before, after, ["currency_code"], "_day", "_day", ["_after"], direction="forward", span="year")
    nearest = F.coalesce("_before", "_after").alias("h_currency_pk")
    return same.unionByName(other.select("currency_code", "_day", nearest).where("h_currency_pk is not null"))


def link_transaction_currency(
    transactions: DataFrame,
    h_transactions: DataFrame,
    h_currencies: DataFrame,
    link: DataFrame | None,
    day: Day,
    load_dt: object,
    source: str,
    key: KeyFunction = md5_key,
) -> DataFrame:
    """Links of the day's operations to a currency version: of their own day, else the latest before, else the first.

    No operation whose currency has any version is lost; its rate is looked up on its own day later on.
    """
    rows = (
        transactions.where(on_day("transaction_dt", day))
        .select("operation_id", "currency_code", F.to_date("transaction_dt").alias("_day"))
        .distinct()
    )
    versions = h_currencies.select("currency_code", F.to_date("date_update").alias("_day"), "h_currency_pk")
    nearest = _nearest_versions(rows.select("currency_code", "_day").distinct(), versions)
    # One currency may hold half of a day's operations.
    pairs = join_hot(rows, nearest, ["currency_code", "_day"]).join(
        h_transactions.select("operation_id", "h_transaction_pk"), "operation_id"
    )
    keys = ["h_transaction_pk", "h_currency_pk"]
    return load_link(pairs, link, "hk_transaction_currency_pk", keys, load_dt, source, key=key)


def sat_rates(currencies: DataFrame, h_currencies: DataFrame, day: Day, load_dt: object, source: str) -> DataFrame:
    """Rates of the day under the currency version of the same update time."""
    return load_satellite(
        currencies.where(on_day("date_update", day)),
        h_currencies,
        ["currency_code", "date_update"],
        "h_currency_pk",
        ["date_update", "currency_code_with", "currency_with_div"],
        load_dt,
        source,
        distinct=False,
    )


def _transaction_satellite(
    transactions: DataFrame, hub: DataFrame, attributes: list[str], day: Day, load_dt: object, source: str, distinct: bool
) -> DataFrame:
    rows = transactions.where(on_day("transaction_dt", day)).select("operation_id", *attributes)
    return load_satellite(
        rows, hub, ["operation_id"], "h_transaction_pk", attributes, load_dt, source, distinct=distinct
    )


def sat_send_info(transactions: DataFrame, hub: DataFrame, day: Day, load_dt: object, source: str) -> DataFrame:
    columns = ["account_number_from", "account_number_to", "country", "transaction_type"]
    return _transaction_satellite(transactions, hub, columns, day, load_dt, source, distinct=True)


def sat_amount(transactions: DataFrame, hub: DataFrame, day: Day, load_dt: object, source: str) -> DataFrame:
    return _transaction_satellite(transactions, hub, ["currency_code", "amount"], day, load_dt, source, distinct=True)


def sat_status(transactions: DataFrame, hub: DataFrame, day: Day, load_dt: object, source: str) -> DataFrame:
    return _transaction_satellite(transactions, hub, ["status", "transaction_dt"], day, load_dt, source, distinct=False)


def daily_currency_metrics(
    h_transactions: DataFrame,
    h_currencies: DataFrame,
    link: DataFrame,
    s_rates: DataFrame,
    s_send_info: DataFrame,
    s_amount: DataFrame,
    s_status: DataFrame,
    day: Day,
    base: int = BASE_CURRENCY,
    excluded_type: str = AUTHORIZATION,
) -> DataFrame:
    """Per date and currency: amount in base currency, transactions, accounts, and their ratio.

    A currency without a rate that day adds nothing to the amount but its transactions count.
    Several statuses or amounts of one operation in a day collapse to one row with the lowest amount;
    each satellite is reduced to that before the joins, so repeats never multiply. The
    satellites meet on the transaction key, so after the first join none is shuffled again.
    """
    status = (
        s_status.where(on_day("transaction_dt", day))
        .select("h_transaction_pk", F.to_date("transaction_dt").alias("date_update"))
        .distinct()
    )
    accounts_of = (
        s_send_info.where(F.col("transaction_type") != excluded_type)
        .select("h_transaction_pk", "account_number_from")
        .distinct()
    )
    amounts = s_amount.groupBy("h_transaction_pk").agg(F.min("amount").alias("amount"))
    rates = s_rates.where(on_day("date_update", day) & (F.col("currency_code_with") == base)).select(
        "h_currency_pk", F.to_date("date_update").alias("date_update"), "currency_with_div"
    )
    per_operation = (
        status.join(h_transactions.select("h_transaction_pk", "operation_id"), "h_transaction_pk")
        .join(accounts_of, "h_transaction_pk")
        .join(amounts, "h_transaction_pk")
        .join(link.select("h_transaction_pk", "h_currency_pk"), "h_transaction_pk")
        .join(h_currencies.select("h_currency_pk", "currency_code"), "h_currency_pk")
        .join(rates, ["h_currency_pk", "date_update"], "left")
        .groupBy("date_update", "currency_code", "operation_id", "account_number_from")
        .agg(F.min("amount").alias("amount"), F.min("currency_with_div").alias("rate"))
    )
    amount = F.when(F.col("currency_code") == base, F.col("amount")).otherwise(F.col("amount") * F.col("rate"))
    accounts = F.countDistinct("account_number_from")
    operations = F.countDistinct("operation_id")
    ratio = operations.cast("decimal(18,0)") / accounts.cast("decimal(18,0)")
    return (
        per_operation.withColumn("_amount", amount.cast("decimal(28,3)"))
        .groupBy("date_update", F.col("currency_code").alias("currency_from"))
        .agg(
            F.sum("_amount").cast("decimal(17,2)").alias("amount_total"),
            operations.alias("cnt_transactions"),
            ratio.cast("decimal(15,2)").alias("avg_transactions_per_account"),
            accounts.alias("cnt_accounts_make_transactions"),
        )
    )
