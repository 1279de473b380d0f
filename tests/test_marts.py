"""Hand-written rows for the special cases of each batch mart."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

from conftest import rows
from martloom.bindings.registry import Tables
from martloom.functions.keys import md5_key
from martloom.operators import quality
from martloom.plans import courier, currency, geo, groups, rfm, sales, shipping
from martloom.plans.calendar import calendar
from pyspark.sql import functions as F


def day(text):
    return dt.datetime.fromisoformat(text)


# Customer segmentation


def test_rfm_metrics_follow_the_rules(spark):
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id int")
    orders = spark.createDataFrame(
        [
            (1, day("2022-03-01"), 4, 10.0),
            (1, day("2022-02-01"), 4, 5.0),
            (1, day("2021-12-31"), 4, 99.0),
            (2, day("2022-05-01"), 5, 7.0),
            (9, day("2022-05-01"), 4, 7.0),
        ],
        "user_id int, order_ts timestamp_ntz, status int, payment double",
    )
    got = rows(rfm.customer_metrics(users, orders), "user_id", "last_order", "order_count", "order_sum")
    assert got == [(1, dt.date(2022, 3, 1), 2, 15.0), (2, dt.date(2021, 1, 1), 0, 0.0)]
    everyone = rfm.customer_metrics(users, orders, replace(rfm.RfmRules(), include_inactive=True))
    assert rows(everyone, "user_id", "order_count") == [(1, 2), (2, 0), (3, 0), (4, 0)]


def test_rfm_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.createDataFrame([(1, day("2022-03-01"), 4, 1.0)], "user_id int, order_ts timestamp_ntz, status int, payment double").write.parquet(path)
    users = spark.createDataFrame([(1,)], "id int")
    plan = rfm.customer_metrics(users, spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_ts,2022-01-01" in plan


# Shipping

LOG = (
    "id int, shipping_id int, payment_amount decimal(14,2), vendor_id int, shipping_plan_datetime timestamp_ntz, "
    "state_datetime timestamp_ntz, status string, state string, shipping_country string, "
    "shipping_country_base_rate decimal(14,3), vendor_agreement_description string, "
    "shipping_transfer_description string, shipping_transfer_rate decimal(14,3)"
)


def log_row(i, ship, at, status, state, *, agreement="1:text:0.14:0.02", transfer="1p:train", rate="0.025"):
    return (
        i, ship, Decimal("100.00"), 7, day("2021-01-03T00:00:00"), day(at), status, state, "usa", Decimal("0.020"),
        agreement, transfer, Decimal(rate),
    )


def shipping_log(spark):
    return spark.createDataFrame(
        [
            log_row(1, 10, "2021-01-01T00:00:00", "in_progress", "booked"),
            log_row(2, 10, "2021-01-02T23:00:00", "finished", "recieved"),
            log_row(3, 20, "2021-01-01T00:00:00", "in_progress", "booked", agreement="2::other:0.10:0.01"),
            log_row(4, 30, "2021-01-01T00:00:00", "in_progress", "booked", rate="0.050"),
            log_row(5, 30, "2021-01-05T12:00:00", "finished", "recieved", rate="0.050"),
            log_row(6, 30, "2021-01-06T12:00:00", "finished", "returned", rate="0.050"),
            log_row(7, 40, "2021-01-01T00:00:00", "finished", "returned"),
        ],
        LOG,
    )


def shipping_tables(spark):
    log = shipping_log(spark)
    rates, agreements = shipping.shipping_country_rates(log), shipping.shipping_agreement(log)
    transfers = shipping.shipping_transfer(log)
    return log, rates, agreements, transfers, shipping.shipping_info(log, rates, agreements, transfers)


def test_shipping_reference_tables(spark):
    _, rates, agreements, transfers, info = shipping_tables(spark)
    assert rows(rates, "id", "shipping_country") == [(1, "usa")]
    assert rows(agreements, "agreement_id", "agreement_number", "agreement_rate") == [
        (1, "text", Decimal("0.140")),
        (2, "other", Decimal("0.100")),
    ]
    assert rows(transfers, "id", "transfer_type", "shipping_transfer_rate") == [
        (1, "1p", Decimal("0.025")),
        (2, "1p", Decimal("0.050")),
    ]
    # One transfer text with two rates must not double the shipments.
    assert rows(info, "shipping_id", "shipping_transfer_id") == [(10, 1), (20, 1), (30, 2), (40, 1)]


def test_shipping_status(spark):
    got = rows(shipping.shipping_status(shipping_log(spark)))
    assert got == [
        (10, "finished", "recieved", day("2021-01-01T00:00:00"), day("2021-01-02T23:00:00")),
        (20, "in_progress", "booked", day("2021-01-01T00:00:00"), None),
        (30, "finished", "returned", day("2021-01-01T00:00:00"), day("2021-01-05T12:00:00")),
    ]


def test_shipping_mart(spark):
    log, rates, agreements, transfers, info = shipping_tables(spark)
    mart = shipping.shipping_datamart(
        info, transfers, shipping.shipping_status(log), agreements, rates, dt.datetime(2021, 1, 3, 12)
    )
    got = rows(mart, "shipping_id", "full_day_at_shipping", "is_delay", "delay_day_at_shipping", "is_shipping_finish", "vat", "profit")
    assert got == [
        (10, 1, False, 0, True, Decimal("18.500"), Decimal("2.000")),
        (20, 2, True, 0, False, Decimal("14.500"), Decimal("1.000")),
        (30, 4, True, 2, True, Decimal("21.000"), Decimal("2.000")),
    ]


# Sales

STAGING = (
    "uniq_id string, date_time timestamp_ntz, city_id int, city_name string, customer_id int, first_name string, "
    "last_name string, item_id int, item_name string, quantity int, payment_amount decimal(14,2), status string"
)


def sale(uniq, at, customer, item, amount, status="shipped", city=1, item_name="item"):
    return (uniq, day(at), city, f"city{city}", customer, "n", "m", item, item_name, 1, Decimal(amount), status)


def test_new_dimension_rows(spark):
    stg = spark.createDataFrame(
        [sale("a", "2021-01-01", 1, 5, "1", city=2, item_name="old"), sale("b", "2021-01-02", 1, 5, "1", city=1, item_name="new"), sale("c", "2021-01-02", 2, 6, "1")],
        STAGING,
    )
    dim = spark.createDataFrame([(6,), (None,)], "item_id int")
    assert rows(sales.new_dimension_rows(stg, dim, "item_id", ["item_name"], ["date_time"])) == [(5, "new")]
    none = spark.createDataFrame([], "customer_id int")
    assert rows(sales.new_customer_rows(stg, none, ["date_time"]), "customer_id", "city_id") == [(1, 2), (2, 1)]


def test_sales_fact_negates_all_but_shipped(spark):
    stg = spark.createDataFrame(
        [sale("a", "2021-01-01", 1, 5, "10"), sale("b", "2021-01-01", 1, 5, "10", "refunded"), sale("c", "2021-01-01", 1, 5, "10", None), sale("d", "2021-01-02", 1, 5, "10")],
        STAGING,
    )
    cal = calendar(spark, dt.date(2021, 1, 1), dt.date(2021, 1, 1))
    fact = sales.sales_fact(stg, cal, "2021-01-01")
    assert rows(fact, "date_id", "payment_amount") == [(20210101, Decimal("-10.00"))] * 2 + [(20210101, Decimal("10.00"))]
    assert rows(sales.sales_fact(stg, cal), "date_id").count((None,)) == 1


def test_retention_keeps_the_iso_week_over_new_year(spark):
    stg = spark.createDataFrame(
        [
            sale("a", "2020-12-31", 1, 5, "10"),
            sale("b", "2021-01-01", 1, 5, "20"),
            sale("c", "2021-01-02", 2, 5, "7"),
            sale("d", "2021-01-03", 3, 5, "4", "refunded"),
            sale("e", "2021-01-04", 3, 5, "4"),
        ],
        STAGING,
    )
    cal = calendar(spark, dt.date(2020, 12, 1), dt.date(2021, 2, 1))
    mart = sales.customer_retention(sales.sales_fact(stg, cal), cal, "2021-01-01")
    [row] = mart.collect()
    assert (row["period_name"], row["period_id"], row["item_id"]) == ("2020-W53", 53, 5)
    assert (row["new_customers_count"], row["returning_customers_count"], row["refunded_customer_count"]) == (1, 1, 1)
    assert (row["new_customers_revenue"], row["returning_customers_revenue"]) == (Decimal("7.00"), Decimal("30.00"))
    assert row["customers_refunded"] == Decimal("-4.00")


# Couriers


def deliveries(spark):
    docs = [
        '{"order_id":"o1","order_ts":"2022-05-01 10:00:00.600","delivery_id":"d1","courier_id":"c1","address":"x","rate":5,"sum":1000,"tip_sum":50.5}',
        '{"order_id":"o9","order_ts":"2022-05-01 10:00:00.400","delivery_id":"d2","courier_id":"c1","address":"y","rate":4,"sum":10,"tip_sum":0}',
        '{"order_id":"o2","delivery_id":"d3","courier_id":"c2","address":"z","rate":2,"sum":100}',
        "not json",
    ]
    return spark.createDataFrame(list(enumerate(docs, 1)), "id int, object_value string")


def test_documents_sent_again_keep_their_id(spark):
    empty = spark.createDataFrame([], "id long, object_id string, object_value string, update_ts timestamp_ntz")
    pull = [('{"_id":"b","name":"1"}', 1), ('{"_id":"a","name":"1"}', 2), ('{"name":"no key"}', 3)]
    first = courier.land_documents(empty, spark.createDataFrame(pull, "object_value string, arrival int"), "_id", day("2022-01-01"))
    again = [('{"_id":"b","name":"2"}', 1), ('{"_id":"b","name":"3"}', 2), ('{"_id":"0","name":"1"}', 3)]
    second = courier.land_documents(first, spark.createDataFrame(again, "object_value string, arrival int"), "_id", day("2022-01-02"))
    assert rows(second, "id", "object_id", "object_value") == [
        (1, "a", '{"_id":"a","name":"1"}'),
        (2, "b", '{"_id":"b","name":"3"}'),
        (3, "0", '{"_id":"0","name":"1"}'),
    ]


def test_courier_increments(spark):
    stg = deliveries(spark)
    orders = spark.createDataFrame([(11, "o1", None), (12, "o2", 9)], "id int, order_key string, courier_id int")
    people = spark.createDataFrame([(1, "c1", "Ann"), (2, "c2", "Bob")], "id int, courier_id string, courier_name string")
    times = spark.createDataFrame([(1, day("2022-05-01T10:00:00")), (2, day("2022-05-01T10:00:01"))], "id int, ts timestamp_ntz")
    assert rows(courier.delivery_dim_increment(stg, orders, 0), "id", "order_id") == [(1, 11), (3, 12)]
    assert rows(courier.delivery_dim_increment(stg, orders, 0, limit=1), "id") == [(1,)]
    assert rows(courier.deliveries_without_order(stg, orders, 0), "id") == [(2,), (4,)]
    # Fractions are rounded to the second.
    assert rows(courier.rate_increment(stg, people, times, 0), "id", "date_id", "rate") == [(1, 2, 5), (2, 1, 4)]
    assert rows(courier.courier_sales_fact(stg, orders, 0), "order_id", "rate", "order_sum", "tips_sum") == [
        (11, 5, Decimal("1000.00"), Decimal("50.50")),
        (12, 2, Decimal("100.00"), None),
    ]
    assert rows(courier.assign_courier(orders, stg, people), "id", "courier_id") == [(11, 1), (12, 2)]


def test_ledger(spark):
    fact = spark.createDataFrame(
        [(1, 11, 5, Decimal("1000.00"), Decimal("50.00")), (1, 12, 4, Decimal("100.00"), Decimal("0.00")), (2, 13, 2, Decimal("100.00"), Decimal("1.00"))],
        "courier_id int, order_id int, rate int, order_sum decimal(14,2), tips_sum decimal(14,2)",
    )
    people = spark.createDataFrame([(1, "c1", "Ann"), (2, "c2", "Bob")], "id int, courier_id string, courier_name string")
    times = spark.createDataFrame([(i, day("2022-05-01")) for i in (11, 12, 13)], "order_id int, order_ts timestamp_ntz")
    tiers = [courier.Tier("4.5", "0.10", "20"), courier.Tier("0", "0.05", "30")]
    got = rows(courier.courier_ledger(fact, people, times, tiers), "courier_id", "orders_count", "rate_avg", "order_processing_fee", "courier_order_sum", "courier_reward_sum")
    # Ann: 100 + max(10, 20); Bob: max(5, 30).
    assert got == [
        ("c1", 2, Decimal("4.50"), Decimal("275.00"), Decimal("120.00"), Decimal("161.50")),
        ("c2", 1, Decimal("2.00"), Decimal("25.00"), Decimal("30.00"), Decimal("29.45")),
    ]


# Groups


def test_group_conversion(spark):
    log = spark.createDataFrame(
        [(1, 1, None, "add", day("2020-01-01")), (1, 2, 5, "add", day("2020-01-01")), (2, 1, None, "add", day("2020-01-02")), (2, 99, None, "add", day("2020-01-02")), (3, 1, None, "leave", day("2020-01-03"))],
        "group_id int, user_id int, user_id_from int, event string, datetime timestamp_ntz",
    )
    users = spark.createDataFrame([(1,), (2,)], "user_id int").withColumn("hk_user_id", md5_key("user_id"))
    known = spark.createDataFrame([(1, day("2020-01-01")), (2, day("2020-01-01")), (3, day("2020-01-01"))], "group_id int, registration_dt timestamp_ntz").withColumn("hk_group_id", md5_key("group_id"))
    link = groups.group_link(log, users, known, day("2020-02-01"), "s3")
    assert link.count() == 4 and groups.group_link(log, users, known, day("2020-02-01"), "s3", link).count() == 0
    history = groups.group_history(log, users, known, link, day("2020-02-01"), "s3")
    assert history.count() == 5 and history.where("hk_l_user_group_activity is null").count() == 1
    wrote = spark.createDataFrame([(1, "m1"), (1, "m2")], "user_id int, hk_message_id string").select(md5_key("user_id").alias("hk_user_id"), "hk_message_id")
    held = spark.createDataFrame([(1, "m1"), (1, "m2")], "group_id int, hk_message_id string").select(md5_key("group_id").alias("hk_group_id"), "hk_message_id")
    got = groups.group_conversion(link, history, known, wrote, held).collect()
    assert [(r["cnt_added_users"], r["cnt_users_in_group_with_messages"], r["group_conversion"]) for r in got] == [(2, 1, 0.5), (1, None, None)]
    assert groups.users_added_to_early_groups(link, history, known, k=1).count() <= 1
    assert groups.users_with_messages(link, wrote, held).count() == 1


# Geo


def test_stays_home_and_travels(spark):
    start = dt.date(2022, 1, 1)
    days = [(1, 1, "a", start + dt.timedelta(days=i)) for i in range(40) if i != 30]
    days += [(1, 2, "b", start + dt.timedelta(days=i)) for i in range(50, 77)] + [(2, 1, "a", start)] * 3
    runs = geo.stays(spark.createDataFrame(days, "user_id int, place_id int, city string, date date"))
    assert rows(runs, "user_id", "city", "count_days") == [(1, "a", 30), (1, "a", 9), (1, "b", 27), (2, "a", 1)]
    assert rows(geo.home_city(runs)) == [(1, "b")]
    assert rows(geo.travel_array(runs)) == [(1, ["a", "a", "b"], 3), (2, ["a"], 1)]


def test_user_mart_with_unlocated_user(spark):
    messages = spark.createDataFrame(
        [(1, 1, 0.1, 0.1, day("2022-01-01T10:00:00"), dt.date(2022, 1, 1)), (2, 1, None, None, day("2022-01-02T10:00:00"), dt.date(2022, 1, 2)), (3, 2, None, None, day("2022-01-02T10:00:00"), dt.date(2022, 1, 2))],
        "event_id int, user_id int, lat double, lon double, ts timestamp_ntz, date date",
    )
    places = spark.createDataFrame([(1, "a", 0.0, 0.0)], "place_id int, city string, lat_city double, lng_city double")
    mart = geo.user_geo_mart(messages, places, "Australia/Sydney", min_days=1)
    assert rows(mart, "user_id", "act_city", "home_city", "travel_count", "travel_array") == [
        (1, None, "a", 1, ["a"]),
        (2, None, None, None, None),
    ]
    assert rows(mart, "local_time")[0] == (day("2022-01-02T21:00:00"),)


def test_coordinates_with_comma(spark):
    raw = spark.createDataFrame([(1, "a", "-33,865", "151,2094"), (2, "b", "bad", None)], "id int, city string, lat string, lng string")
    got = rows(geo.clean_coordinates(raw), "place_id", "lat_city", "lng_city")
    assert round(got[0][1], 3) == -33.865 and got[1] == (2, None, None)


def test_pairs_that_wrote_in_any_direction_are_left_out(spark):
    subs = spark.createDataFrame([(1, u) for u in (1, 2, 3, 4)] + [(None, 5)], "channel int, user_id int")
    seen = spark.createDataFrame([(u, -33.0, 151.0, 7, day("2022-01-01")) for u in (1, 2, 3)] + [(4, -34.0, 151.0, 7, None)], "user_id int, lat double, lon double, zone_id int, local_time timestamp_ntz")
    wrote = spark.createDataFrame([(2, 1), (9, None)], "sender int, receiver int")
    got = geo.recommend_pairs(subs, seen, wrote, day("2022-02-01"))
    assert rows(got, "user_left", "user_right", "zone_id") == [(1, 3, 7), (2, 3, 7)]


# Currency vault


def currency_tables(spark):
    tx = spark.createDataFrame(
        [
            ("t1", 1, 2, 430, "x", "queued", "sbp", 100, day("2022-10-01T10:00:00")),
            ("t1", 1, 2, 430, "x", "done", "sbp", 100, day("2022-10-01T11:00:00")),
            ("t2", 1, 3, 430, "x", "done", "sbp", 50, day("2022-10-01T12:00:00")),
            ("t3", 5, 3, 430, "x", "done", "authorization", 7, day("2022-10-01T12:00:00")),
            ("t4", -1, 3, 430, "x", "done", "sbp", 7, day("2022-10-01T12:00:00")),
            ("t5", 6, 3, 420, "x", "done", "sbp", 9, day("2022-10-01T12:00:00")),
            ("t6", 6, 3, 410, "x", "done", "sbp", 9, day("2022-10-01T12:00:00")),
            ("t7", 6, 3, 430, "x", "done", "sbp", 9, day("2022-10-02T12:00:00")),
        ],
        "operation_id string, account_number_from int, account_number_to int, currency_code int, country string, "
        "status string, transaction_type string, amount int, transaction_dt timestamp_ntz",
    )
    rates = spark.createDataFrame(
        [
            (day("2022-10-01T00:00:00"), 430, 420, Decimal("1.500")),
            (day("2022-10-02T00:00:00"), 430, 420, Decimal("2.000")),
            (day("2022-10-01T00:00:00"), 420, 430, Decimal("0.600")),
            (day("2022-10-01T00:00:00"), 410, 430, Decimal("3.000")),
        ],
        "date_update timestamp_ntz, currency_code int, currency_code_with int, currency_with_div decimal(5,3)",
    )
    return tx, rates


def currency_metrics(spark, ds, source_day):
    tx, rates = currency_tables(spark)
    stamp = (day("2022-10-03"), "pg")
    h_tx = currency.hub_transactions(tx, None, source_day, *stamp)
    h_cur = currency.hub_currencies(rates, None, source_day, *stamp)
    link = currency.link_transaction_currency(tx, h_tx, h_cur, None, source_day, *stamp)
    mart = currency.daily_currency_metrics(
        h_tx, h_cur, link, currency.sat_rates(rates, h_cur, source_day, *stamp),
        currency.sat_send_info(tx, h_tx, source_day, *stamp), currency.sat_amount(tx, h_tx, source_day, *stamp),
        currency.sat_status(tx, h_tx, source_day, *stamp), ds,
    )
    return rows(mart, "date_update", "currency_from", "amount_total", "cnt_transactions", "avg_transactions_per_account", "cnt_accounts_make_transactions")


FIRST_DAY = [
    (dt.date(2022, 10, 1), 410, None, 1, Decimal("1.00"), 1),
    (dt.date(2022, 10, 1), 420, Decimal("9.00"), 1, Decimal("1.00"), 1),
    (dt.date(2022, 10, 1), 430, Decimal("225.00"), 2, Decimal("2.00"), 1),
]
SECOND_DAY = [(dt.date(2022, 10, 2), 430, Decimal("18.00"), 1, Decimal("1.00"), 1)]


def test_daily_metrics(spark):
    assert currency_metrics(spark, "2022-10-01", None) == FIRST_DAY
    assert currency_metrics(spark, "2022-10-01", "2022-10-01") == FIRST_DAY
    assert currency_metrics(spark, None, None) == FIRST_DAY + SECOND_DAY


def test_hub_loaded_twice_adds_nothing(spark):
    tx, rates = currency_tables(spark)
    hub = currency.hub_transactions(tx, None, "2022-10-01", day("2022-10-02"), "pg")
    assert rows(hub, "operation_id") == [("t1",), ("t2",), ("t3",), ("t5",), ("t6",)]
    assert currency.hub_transactions(tx, hub, "2022-10-01", day("2022-10-02"), "pg").count() == 0
    assert rows(currency.hub_transactions(tx, hub, "2022-10-02", day("2022-10-03"), "pg"), "operation_id") == [("t7",)]


# Data quality


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 9), (2, None, None), (3, "b", 0)], "k int, v string, n int")
    assert rows(quality.duplicate_report(df, ["k"])) == [(4, 3)]
    assert rows(quality.null_report(df, ["k", "v", "n"])) == [("k", 0), ("n", 1), ("v", 1)]
    assert quality.check_not_null(df, ["k", "v"]).count() == 1
    assert rows(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert rows(quality.check_range(df, "n", 1, 5), "n") == [(0,), (9,)]
    assert rows(quality.check_expr(df, "small", "n < 6"), "n", "rule") == [(9, "small")]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.check_fk(df, parent, {"k": "id"})) == [(2, 1), (3, 1)]
    empty = df.where("k > 99")
    assert rows(quality.duplicate_report(empty, ["k"])) == [(0, 0)]


def test_calendar_weeks(spark):
    cal = calendar(spark, dt.date(2020, 12, 31), dt.date(2021, 1, 4))
    assert rows(cal, "date_id", "week_of_year", "week_of_year_iso")[0] == (20201231, 53, "2020-W53")
    assert rows(cal.where(F.col("date_id") == 20210104), "week_of_year_iso") == [("2021-W01",)]


def test_shuffle_partitions_follow_the_size_of_the_rows(spark):
    """As many partitions as cores would make a task's memory grow with the tables."""
    Tables(spark, "/nowhere")
    few, many = (spark.range(n).select(F.xxhash64("id").alias("k"), F.xxhash64("id", F.lit(1)).alias("v")).groupBy("k").agg(F.max("v")) for n in (1_000, 5_000_000))
    assert few.rdd.getNumPartitions() <= 4 < many.rdd.getNumPartitions()
