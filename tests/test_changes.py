from __future__ import annotations

import datetime as dt

from conftest import rows
from martloom.operators import changes, loads
from martloom.plans import courier

DAY = dt.datetime(2024, 1, 1)
DOC = '{"order_id":"%s","order_ts":"2022-05-01 10:00:00","delivery_id":"%s","courier_id":"%s","address":"x","rate":5,"sum":1,"tip_sum":0}'


def test_changes_tell_nulls_from_values(spark):
    schema = "k int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (2, "same", None), (3, "gone", "y"), (None, "n", "n")], schema)
    new = spark.createDataFrame([(1, None, "x"), (2, "same", None), (4, None, None), (None, "n", "m")], schema)
    found = changes.capture_changes(old, new, ["k"])
    assert rows(found) == sorted(
        [(1, None, "x", "update"), (3, "gone", "y", "delete"), (4, None, None, "insert"), (None, "n", "m", "update")], key=repr
    )
    assert changes.capture_changes(new, new, ["k"]).count() == 0
    assert rows(changes.capture_changes(old, new, ["k"], ["b"]), "k", "change") == sorted(
        [(1, "update"), (3, "delete"), (4, "insert"), (None, "update")], key=repr
    )


def test_a_walk_over_tied_marks_gives_every_row_once(spark, tmp_path):
    path, at = str(tmp_path / "marks"), dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    times = [at, at, at, at + dt.timedelta(microseconds=1), at + dt.timedelta(days=1)]
    src = spark.createDataFrame([(times[i % 5], i) for i in range(23)], "ts timestamp, id int").repartition(3)
    seen, pages = [], 0
    while True:
        page = loads.page_after(src, ("ts", "id"), loads.read_cursor(spark, path, "walk"), 4)
        got = [r.id for r in page.collect()]
        if not got:
            break
        seen += got
        pages += 1
        loads.write_cursor(spark, path, "walk", loads.next_cursor(page, ("ts", "id")).first()["cursor"], at)
    assert pages == 6 and seen == sorted(range(23), key=lambda i: (times[i % 5], i))
    loads.write_cursor(spark, path, "walk", None, at)
    assert loads.read_cursor(spark, path, "walk")[1] == str(seen[-1]) and loads.read_cursor(spark, path, "other") is None


def test_leading_cursor_column_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id % 3 as mark", "id").write.parquet(str(tmp_path / "t"))
    page = loads.page_after(spark.read.parquet(str(tmp_path / "t")), ("mark", "id"), ("1", "4"))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(mark,1)" in plan
    assert rows(page) == [(1, 7), (2, 2), (2, 5), (2, 8)]


def test_two_documents_of_an_order_stay_on_one_page(spark):
    stg = spark.createDataFrame([(1, DOC % ("o1", "d1", "c1")), (2, DOC % ("o1", "d2", "c1")), (3, DOC % ("o2", "d3", "c1"))], "id int, object_value string")
    orders = spark.createDataFrame([(1, "o1", 7), (2, "o2", 7)], "id int, order_key string, courier_id int")
    assert rows(courier.courier_sales_fact(stg, orders, 0, limit=1), "id") == [(1,), (1,)]
    assert rows(courier.courier_sales_fact(stg, orders, 1, limit=1), "id") == [(2,)]


def test_documents_wait_for_their_order_and_are_loaded_once(spark):
    stg = spark.createDataFrame([(i, DOC % (f"o{i}", f"d{i}", "c1")) for i in (1, 2, 3)], "id int, object_value string")
    orders = spark.createDataFrame([(11, "o1", None)], "id int, order_key string, courier_id int")
    waits = courier.deliveries_waiting(stg, orders, 0, DAY, limit=2)
    assert rows(waits, "id", "waiting_since") == [(2, DAY)]
    more = orders.union(spark.createDataFrame([(12, "o2", None)], orders.schema))
    later = DAY + dt.timedelta(days=3)
    assert rows(courier.delivery_dim_increment(stg, more, 2, waiting=waits), "id", "order_id") == [(2, 12)]
    assert rows(courier.deliveries_waiting(stg, more, 2, later, waiting=waits), "id", "waiting_since") == [(3, later)]
    both = courier.deliveries_waiting(stg, orders, 2, later, waiting=waits)
    again, late = changes.overdue(both, later, max_days=2)
    assert rows(again, "id") == [(3,)] and rows(late, "id", "waiting_since") == [(2, DAY)]


def test_a_fresh_version_replaces_the_waiting_one(spark):
    fresh = spark.createDataFrame([(1, "new"), (2, "x")], "id int, v string")
    waits = spark.createDataFrame([(1, "old", DAY), (3, "y", DAY)], "id int, v string, waiting_since timestamp")
    assert rows(changes.with_waiting(fresh, waits, ["id"])) == [(1, "new", DAY), (2, "x", None), (3, "y", DAY)]
