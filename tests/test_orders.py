"""Order messages: vault tables, counters and their stream."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from conftest import rows
from martloom.plans import orders
from martloom.streaming.orders import counters_stream, current_vault, vault_stream
from martloom.streaming.sinks import current_rows, table_sink
from pyspark.sql import functions as F

LOAD_DT = dt.datetime(2024, 1, 1)


def key(text):
    return str(uuid.uuid3(uuid.NAMESPACE_X500, text))


def message(order, status="CLOSED", cost="10.5", user=None, products=None, object_type="order"):
    user = user or {"id": "u1", "name": "Имя"}
    products = products if products is not None else [
        {"id": "p1", "name": "Чай", "category": "c1"},
        {"id": "p1", "name": "Чай", "category": "c1"},
        {"id": "p2", "name": "Кофе", "category": "c1"},
    ]
    payload = {"id": order, "date": "2022-01-01", "cost": "COST", "payment": 7, "status": status, "user": user, "restaurant": {"id": "r1", "name": "R"}, "products": products}
    body = {"object_id": order, "payload": payload}
    if object_type is not None:
        body["object_type"] = object_type
    return json.dumps(body, ensure_ascii=False).replace('"COST"', cost)


def raw(spark, *texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, place long")


def parsed(spark, *texts):
    return orders.parse_messages(raw(spark, *texts), "place")


def test_only_order_messages_pass(spark):
    messages = parsed(spark, message(1), message(2, object_type=None), message(3, object_type="user"), "broken", "{}")
    assert rows(orders.order_rows(messages), "order_id") == [(1,)]


def test_vault_keys_equal_python(spark):
    vault = orders.order_vault(parsed(spark, message(1)), LOAD_DT, order_by=["place"])
    assert set(vault) == set(orders.VAULT_TABLES) and len(vault) == 14
    h_order, h_user, h_product, h_category, h_restaurant = key("1"), key("u1"), key("p1"), key("c1"), key("r1")
    assert rows(vault["h_order"], "h_order_pk", "order_id", "order_dt", "load_src") == [(h_order, 1, "2022-01-01", "orders_kafka")]
    assert rows(vault["h_user"], "h_user_pk", "user_id") == [(h_user, "u1")]
    assert rows(vault["h_product"], "h_product_pk") == sorted([(h_product,), (key("p2"),)])
    assert rows(vault["h_category"], "h_category_pk", "category_name") == [(h_category, "c1")]
    assert rows(vault["l_order_user"], "hk_order_user_pk") == [(key(h_order + h_user),)]
    assert (key(h_order + h_product),) in rows(vault["l_order_product"], "hk_order_product_pk")
    assert (key(h_product + h_restaurant),) in rows(vault["l_product_restaurant"], "hk_product_restaurant_pk")
    assert (key(h_product + h_category),) in rows(vault["l_product_category"], "hk_product_category_pk")
    assert rows(vault["s_user_names"], "hk_user_names_hashdiff", "userlogin") == [(key("u1ИмяИмя"), "Имя")]
    assert rows(vault["s_restaurant_names"], "hk_restaurant_names_hashdiff") == [(key("r1R"),)]
    assert rows(vault["s_order_status"], "hk_order_status_hashdiff") == [(key("1CLOSED"),)]
    assert (key("p1Чай"),) in rows(vault["s_product_names"], "hk_product_names_hashdiff")
    assert vault["l_order_product"].count() == 2 and vault["s_product_names"].count() == 2


@pytest.mark.parametrize("cost", ["10.5", "10", "1234567.25", "0.1", "10000000.0", "12345678.9", "10000000", "0.0005"])
def test_cost_is_hashed_with_its_own_digits(spark, cost):
    table = orders.vault_table(parsed(spark, message(1, cost=cost)), "s_order_cost", LOAD_DT)
    assert rows(table, "hk_order_cost_hashdiff", "cost", "payment") == [(key("1" + cost + "7"), cost, "7")]


def test_login_overrides_the_name(spark):
    user = {"id": "u1", "name": "A", "login": "log"}
    table = orders.vault_table(parsed(spark, message(1, user=user)), "s_user_names", LOAD_DT)
    assert rows(table, "hk_user_names_hashdiff", "username", "userlogin") == [(key("u1Alog"), "A", "log")]


def test_last_message_wins(spark):
    later = json.loads(message(1))
    later["payload"]["date"] = "2022-09-09"
    messages = parsed(spark, message(1), json.dumps(later))
    assert rows(orders.vault_table(messages, "h_order", LOAD_DT, order_by=["place"]), "order_dt") == [("2022-09-09",)]


def test_satellite_conflict_on_joined_text(spark):
    """('ab', 'c') and ('a', 'bc') share a change key; one row is stored."""
    one, two = {"id": "ab", "name": "c"}, {"id": "a", "name": "bc"}
    messages = parsed(spark, message(1, products=[{**one, "category": "x"}]), message(2, products=[{**two, "category": "x"}]))
    table = orders.vault_table(messages, "s_product_names", LOAD_DT, order_by=["place"])
    assert rows(table, "product_name") == [("bc",)]


def test_merge_refreshes_load_time_unless_first_seen(spark):
    old = orders.vault_table(parsed(spark, message(1)), "h_user", dt.datetime(2024, 1, 1))
    new = orders.vault_table(parsed(spark, message(1)), "h_user", dt.datetime(2024, 1, 2))
    assert orders.merge_vault_table(old, new, "h_user").first()["load_dt"] == dt.datetime(2024, 1, 2)
    assert orders.merge_vault_table(old, new, "h_user", first_seen=True).first()["load_dt"] == dt.datetime(2024, 1, 1)


def test_merge_of_satellite_keeps_the_parent(spark):
    table = orders.vault_table(parsed(spark, message(1)), "s_product_names", LOAD_DT)
    other = table.withColumn("h_product_pk", F.lit("other")).withColumn("load_dt", F.lit(dt.datetime(2024, 1, 2)))
    merged = orders.merge_vault_table(table, other, "s_product_names")
    assert rows(merged, "h_product_pk") == rows(table, "h_product_pk")


def test_closed_items_and_counters(spark):
    items = orders.closed_order_items(parsed(spark, message(1), message(2, status="OPEN"), message(3)), "place")
    assert items.count() == 6
    assert rows(orders.user_product_counters(items, ["place"]), "product_id", "product_name", "order_cnt") == sorted(
        [(key("p1"), "Чай", 4), (key("p2"), "Кофе", 2)]
    )
    assert rows(orders.user_category_counters(items), "category_id", "order_cnt") == [(key("c1"), 6)]


def test_downstream_message(spark):
    items = orders.closed_order_items(parsed(spark, message(1)))
    sent = [json.loads(r["value"]) for r in orders.downstream_messages(items).collect()]
    assert {m["object_type"] for m in sent} == {"cdm_message"} and len({m["object_id"] for m in sent}) == 3
    assert sent[0]["payload"]["user_id"] == key("u1")
    assert rows(orders.parse_downstream(orders.downstream_messages(items)), "order_id") == [(key("1"),)] * 3


def test_counter_name_is_refreshed(spark):
    renamed = [{"id": "p1", "name": "new", "category": "c1"}]
    items = orders.closed_order_items(parsed(spark, message(1), message(2, products=renamed)), "place")
    got = rows(orders.user_product_counters(items, ["place"]), "product_id", "product_name")
    assert (key("p1"), "new") in got


def stream_of(spark, folder, frames):
    """One file, and so one micro-batch, per frame."""
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").json(folder)
        assert i >= 0
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).json(folder)


def test_streamed_vault_equals_batch(spark, tmp_path):
    texts = [message(1), message(2, status="OPEN"), message(1), message(3, user={"id": "u2", "name": "B"})]
    frame = raw(spark, *texts)
    source = stream_of(spark, str(tmp_path / "in"), [frame.where("place < 2"), frame.where("place >= 2")])
    job = dict(message_id=F.col("place").cast("string"), order_by=["place"], trigger={"availableNow": True})
    root, checkpoint = str(tmp_path / "vault"), str(tmp_path / "checkpoint")
    topic = table_sink(str(tmp_path / "topic"))
    vault_stream(source, root, checkpoint, to_topic=topic, **job).awaitTermination()
    batch = orders.order_vault(orders.parse_messages(frame, "place"), LOAD_DT, order_by=["place"])
    for table, spec in orders.VAULT_TABLES.items():
        assert rows(current_vault(spark, root, table), *spec.columns) == rows(batch[table], *spec.columns), table
    handed = orders.parse_downstream(spark.read.parquet(str(tmp_path / "topic")))
    assert handed.count() == 9 and handed.select("object_id").distinct().count() == 9
    # Nothing new: nothing changes.
    vault_stream(source, root, checkpoint, to_topic=topic, **job).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 9


def counter_items(spark, *items):
    schema = "object_id string, user_id string, product_id string, product_name string, ts timestamp"
    return spark.createDataFrame(list(items), schema)


def test_streamed_counters_survive_replays(spark, tmp_path):
    at = [dt.datetime(2024, 1, 1, 0, minute) for minute in range(5)]
    first = counter_items(spark, ("m1", "u", "p", "old", at[0]), ("m2", "u", "p", "old", at[1]), ("m3", "u", "q", "q", at[1]))
    second = counter_items(spark, ("m1", "u", "p", "old", at[0]), ("m4", "u", "p", "new", at[2]), ("m2", "u", "p", "old", at[1]))
    source = stream_of(spark, str(tmp_path / "in"), [first, second])
    path = str(tmp_path / "out")
    counters_stream(source, "product_id", "product_name", path, str(tmp_path / "cp"), ts_col="ts", trigger={"availableNow": True}).awaitTermination()
    got = rows(current_rows(spark, path, ["user_id", "product_id"]), "product_id", "product_name", "order_cnt")
    assert got == [("p", "new", 3), ("q", "q", 1)]


def test_vault_keys_are_made_with_one_digest_each(spark):
    for table, digests in {"l_order_product": 3, "h_order": 1, "s_user_names": 2}.items():
        built = orders.vault_table(parsed(spark, message(1)), table, LOAD_DT, order_by=["place"])
        assert built._jdf.queryExecution().optimizedPlan().toString().count("md5(") == digests


def test_whole_lines_make_the_same_tables(spark):
    messages = parsed(spark, message(1), message(2, products=[]), message(2, status="NEW", products=[]), message(3, products=[None]))
    lines = orders.product_rows(orders.order_rows(messages, "place"), whole=True)
    assert rows(lines.where("line is null"), "order_id") == [(2,), (2,)]
    for table in orders.VAULT_TABLES:
        expected = rows(orders.vault_table(messages, table, LOAD_DT, order_by=["place"]))
        assert rows(orders.table_of_rows(lines, table, LOAD_DT, order_by=["place"])) == expected, table
    assert rows(orders.closed_line_items(lines, "place")) == rows(orders.closed_order_items(messages, "place"))


def test_a_streamed_vault_leaves_no_batch_lines_and_packed_tables(spark, tmp_path):
    source = stream_of(spark, str(tmp_path / "in"), [raw(spark, message(1)), raw(spark, message(2))])
    root, freed = tmp_path / "vault", []

    def topic(batch, batch_id):
        freed.append(batch.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        assert batch.count() == 3 and any((root / "batch-lines").glob("*.zstd.parquet"))

    job = dict(message_id=F.col("place").cast("string"), order_by=["place"], trigger={"availableNow": True})
    vault_stream(source, str(root), str(tmp_path / "checkpoint"), to_topic=topic, **job).awaitTermination()
    assert freed == ["true", "true"] and {p.name for p in root.iterdir()} == set(orders.VAULT_TABLES)
    files = list(root.rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
