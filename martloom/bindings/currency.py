"""Orders as transactions: currency codes from customer numbers, rates per currency and order day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.bindings.registry import Tables, plain, query
from martloom.functions.keys import hash_key
from martloom.operators.lineage import cut_lineage
from martloom.operators.vault import probed_keys
from martloom.plans import currency

LOAD_DT = dt.datetime(2024, 2, 1)
SOURCE = "pg"
EXCLUDED = "4-NOT SPECIFIED"
STAMP = "'2024-02-01 00:00:00.000000' as load_dt, 'pg' as load_src"
DAY = "1998-03-10"

VAULT_SQL = """
with tx as (
  select cast(o_orderkey as varchar) as operation_id,
         case when o_custkey % 50 = 7 then -o_custkey else o_custkey end as account_number_from,
         o_custkey + 1 as account_number_to, 400 + o_custkey % 25 as currency_code,
         'C' || cast(o_custkey % 25 as varchar) as country, o_orderstatus as status,
         o_orderpriority as transaction_type, cast(floor(o_totalprice) as bigint) as amount,
         o_orderdate as transaction_dt from orders),
rates as (
  select distinct transaction_dt as date_update, currency_code,
         case when day(transaction_dt) = 5 then 430 else 420 end as currency_code_with,
         cast(cast(currency_code - 399 as varchar) || '.125' as decimal(5,3)) as currency_with_div from tx
  where not (day(transaction_dt) = 7 and currency_code % 3 = 0)),
h_tx as (
  select md5(operation_id) as h_transaction_pk, operation_id from tx where account_number_from >= 0),
h_cur as (
  select distinct md5(concat_ws(chr(31), cast(currency_code as varchar), strftime(date_update, '%Y-%m-%d %H:%M:%S')))
           as h_currency_pk, currency_code, date_update from rates),
valid as (select t.*, h.h_transaction_pk from tx t join h_tx h using (operation_id)),
metrics as (
  select cast(transaction_dt as date) as d, v.currency_code, operation_id, account_number_from,
         case when v.currency_code = 420 then amount
              when r.currency_code_with = 420 then amount * r.currency_with_div end as amount
  from valid v left join rates r on v.currency_code = r.currency_code and v.transaction_dt = r.date_update
  where transaction_type <> '4-NOT SPECIFIED')
"""


def transactions(t: Tables) -> DataFrame:
    """Every fiftieth customer is a test account."""
    key = F.col("o_custkey")
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("operation_id"),
        F.when(key % 50 == 7, -key).otherwise(key).alias("account_number_from"),
        (key + 1).alias("account_number_to"),
        (key % 25 + 400).alias("currency_code"),
        F.concat(F.lit("C"), key % 25).alias("country"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.floor("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("transaction_dt"),
    )


def currencies(t: Tables) -> DataFrame:
    """A rate per currency and day; on the fifth of a month only against another currency, on the seventh not for all."""
    return (
        transactions(t)
        .where(~((F.dayofmonth("transaction_dt") == 7) & (F.col("currency_code") % 3 == 0)))
        .select(F.col("transaction_dt").alias("date_update"), "currency_code")
        .distinct()
        .select(
            "date_update",
            "currency_code",
            F.when(F.dayofmonth("date_update") == 5, 430).otherwise(420).alias("currency_code_with"),
            F.concat((F.col("currency_code") - 399).cast("string"), F.lit(".125"))
            .cast("decimal(5,3)")
            .alias("currency_with_div"),
        )
    )


def hub_tx(t: Tables) -> DataFrame:
    return currency.hub_transactions(transactions(t), None, None, LOAD_DT, SOURCE)


def hub_cur(t: Tables) -> DataFrame:
    return currency.hub_currencies(currencies(t), None, None, LOAD_DT, SOURCE)


def link(t: Tables, operations: DataFrame, versions: DataFrame) -> DataFrame:
    return currency.link_transaction_currency(transactions(t), operations, versions, None, None, LOAD_DT, SOURCE)


@query("hub_transactions", VAULT_SQL + f"select h_transaction_pk, operation_id, {STAMP} from h_tx")
def hub_transactions(t: Tables) -> DataFrame:
    return plain(hub_tx(t))


@query(
    "hub_transactions_increment",
    VAULT_SQL
    + f"""select h_transaction_pk, operation_id, {STAMP} from h_tx join tx using (operation_id)
          where cast(transaction_dt as date) >= date '1998-01-01'""",
)
def hub_increment(t: Tables) -> DataFrame:
    """Loaded over a hub that holds the operations before 1998."""
    rows = transactions(t)
    held = currency.hub_transactions(rows.where("transaction_dt < '1998-01-01'"), None, None, LOAD_DT, SOURCE)
    return plain(currency.hub_transactions(rows, held, None, LOAD_DT, SOURCE))


@query("hub_transactions_hash64")
def hub_hash64(t: Tables) -> DataFrame:
    """The same hub under 64-bit keys, which SQL has no equal for."""
    return plain(currency.hub_transactions(transactions(t), None, None, LOAD_DT, SOURCE, key=hash_key))


@query(
    "hub_hash64_audit",
    VAULT_SQL + "select operation_id, 1 as holders from h_tx",
)
def hub_hash64_audit(t: Tables) -> DataFrame:
    """How many operations share the 64-bit key of each one: itself alone."""
    hub = currency.hub_transactions(transactions(t), None, None, LOAD_DT, SOURCE, key=hash_key)
    holders = hub.groupBy("h_transaction_pk").agg(F.count(F.lit(1)).alias("holders"))
    return plain(hub.join(holders, "h_transaction_pk").select("operation_id", "holders"))


@query(
    "hub_probed_keys",
    """with held as (select distinct o_orderkey // 4 as pk from orders where o_orderkey % 5 <> 0),
            first as (select o_orderkey, o_orderkey // 4 as pk, o_orderkey % 5 <> 0 as early from orders),
            won as (select arg_min(o_orderkey, (not early, o_orderkey)) as o_orderkey from first group by pk)
       select o_orderkey, case when o_orderkey in (select o_orderkey from won) then o_orderkey // 4
                               else 1000000000 + o_orderkey end as pk from orders""",
)
def hub_probed_keys(t: Tables) -> DataFrame:
    """Two loads under a key that up to four orders share; each order ends with a key of its own."""

    def key(probe: int) -> Column:
        own = F.col("o_orderkey")
        return F.floor(own / 4).cast("long") if probe == 0 else F.lit(1_000_000_000 * probe).cast("long") + own

    early = F.col("o_orderkey") % 5 != 0
    first = probed_keys(t.orders.where(early), None, "pk", ["o_orderkey"], key=key)
    second = probed_keys(t.orders, first, "pk", ["o_orderkey"], key=key)
    return plain(first.unionByName(second).select("o_orderkey", "pk"))


@query(
    "hub_currencies",
    VAULT_SQL
    + f"""select h_currency_pk, currency_code, strftime(date_update, '%Y-%m-%d %H:%M:%S.%f') as date_update, {STAMP}
          from h_cur""",
)
def hub_currencies(t: Tables) -> DataFrame:
    return plain(hub_cur(t))


@query(
    "link_transaction_currency",
    VAULT_SQL
    + f"""select md5(concat_ws(chr(31), h_transaction_pk, h_currency_pk)) as hk_transaction_currency_pk,
                 h_transaction_pk, h_currency_pk, {STAMP}
          from valid v join h_cur c on v.currency_code = c.currency_code
          qualify row_number() over (partition by v.operation_id order by
                    case when c.date_update = v.transaction_dt then 0 when c.date_update < v.transaction_dt then 1 else 2 end,
                    abs(datediff('day', c.date_update::date, v.transaction_dt::date))) = 1""",
)
def link_query(t: Tables) -> DataFrame:
    return plain(link(t, hub_tx(t), hub_cur(t)))


@query(
    "sat_rates",
    VAULT_SQL
    + f"""select h_currency_pk, strftime(r.date_update, '%Y-%m-%d %H:%M:%S.%f') as date_update,
                 cast(currency_code_with as bigint) as currency_code_with,
                 cast(currency_with_div as double) as currency_with_div, {STAMP}
          from rates r join h_cur c on r.currency_code = c.currency_code and r.date_update = c.date_update""",
)
def rates_query(t: Tables) -> DataFrame:
    return plain(currency.sat_rates(currencies(t), hub_cur(t), None, LOAD_DT, SOURCE))


@query(
    "sat_send_info",
    VAULT_SQL
    + f"select h_transaction_pk, account_number_from, account_number_to, country, transaction_type, {STAMP} from valid",
)
def send_info(t: Tables) -> DataFrame:
    return plain(currency.sat_send_info(transactions(t), hub_tx(t), None, LOAD_DT, SOURCE))


@query("sat_amount", VAULT_SQL + f"select h_transaction_pk, currency_code, amount, {STAMP} from valid")
def amount(t: Tables) -> DataFrame:
    return plain(currency.sat_amount(transactions(t), hub_tx(t), None, LOAD_DT, SOURCE))


@query(
    "sat_status",
    VAULT_SQL
    + f"""select h_transaction_pk, status, strftime(transaction_dt, '%Y-%m-%d %H:%M:%S.%f') as transaction_dt, {STAMP}
          from valid""",
)
def status(t: Tables) -> DataFrame:
    return plain(currency.sat_status(transactions(t), hub_tx(t), None, LOAD_DT, SOURCE))


METRICS_SQL = """
select cast(d as varchar) as date_update, currency_code as currency_from, cast(sum(amount) as double) as amount_total,
       count(distinct operation_id) as cnt_transactions,
       cast((count(distinct operation_id) * 200 + count(distinct account_number_from))
            // (2 * count(distinct account_number_from)) as bigint) / 100.0 as avg_transactions_per_account,
       count(distinct account_number_from) as cnt_accounts_make_transactions
from (select d, currency_code, operation_id, account_number_from, min(amount) as amount from metrics group by all)
{where} group by d, currency_code
"""


def metrics(t: Tables, day: str | None) -> DataFrame:
    tx = transactions(t)
    # Hubs are stored tables; here a checkpoint stands for them, as six of the mart's inputs use them.
    operations, versions = cut_lineage(hub_tx(t)), cut_lineage(hub_cur(t))
    return currency.daily_currency_metrics(
        operations,
        versions,
        link(t, operations, versions),
        currency.sat_rates(currencies(t), versions, None, LOAD_DT, SOURCE),
        currency.sat_send_info(tx, operations, None, LOAD_DT, SOURCE),
        currency.sat_amount(tx, operations, None, LOAD_DT, SOURCE),
        currency.sat_status(tx, operations, None, LOAD_DT, SOURCE),
        day,
        excluded_type=EXCLUDED,
    )


@query(
    "daily_currency_metrics",
    "select * replace (cast(cast(floor(amount_total * 100 + 0.5) as bigint) / 100.0 as double) as amount_total) from ("
    + VAULT_SQL
    + METRICS_SQL.format(where="")
    + ")",
)
def daily_metrics(t: Tables) -> DataFrame:
    return plain(metrics(t, None))


@query(
    "daily_currency_metrics_day",
    "select * replace (cast(cast(floor(amount_total * 100 + 0.5) as bigint) / 100.0 as double) as amount_total) from ("
    + VAULT_SQL
    + METRICS_SQL.format(where=f"where d = date '{DAY}'")
    + ")",
)
def daily_metrics_day(t: Tables) -> DataFrame:
    return plain(metrics(t, DAY))
