from __future__ import annotations

import json
import time

import pytest
from conftest import rows
from martloom.plans import campaign
from martloom.streaming.campaign import campaign_stream
from martloom.streaming.sinks import table_sink
from pyspark.sql import functions as F

NOW = 1_000_000


def text(restaurant, start, end):
    names = [f.name for f in campaign.CAMPAIGN_SCHEMA]
    return json.dumps(dict(zip(names, [restaurant, "c", "content", "owner", "contact", start, end, 5])))


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def subscribers(spark):
    return spark.createDataFrame([(1, "ann", "r1"), (2, "bob", "r1"), (3, "eve", "r9")], "id int, client_id string, restaurant_id string")


def test_bounds_are_open_and_bad_json_is_dropped(spark):
    source = raw(spark, text("r1", NOW - 1, NOW + 1), text("r1", NOW, NOW + 9), text("r1", 1, NOW), "broken", text("r2", 1, NOW + 1))
    got = campaign.campaign_match(source, subscribers(spark), F.lit(NOW))
    assert rows(got, "client_id", "trigger_datetime_created") == [("ann", NOW), ("bob", NOW)]
    values = [json.loads(r["value"]) for r in campaign.campaign_messages(got).collect()]
    assert list(values[0]) == [*[f.name for f in campaign.CAMPAIGN_SCHEMA], "client_id", "trigger_datetime_created"]
    assert campaign.feedback_rows(got).where("feedback is null").count() == 2


def start(spark, tmp_path, to_table, to_topic):
    source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    return campaign_stream(source, subscribers(spark), to_table, to_topic, str(tmp_path / "cp"), {"availableNow": True})


def test_stream_writes_both_sinks_and_takes_now_per_batch(spark, tmp_path):
    folder, table, topic = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "topic")
    now = int(time.time())
    raw(spark, text("r1", 1, now + 3600), text("r1", 1, now + 1)).coalesce(1).write.mode("append").text(folder)
    time.sleep(2)
    start(spark, tmp_path, table_sink(table), table_sink(topic)).awaitTermination()
    raw(spark, text("r1", 1, now + 3600)).coalesce(1).write.mode("append").text(folder)
    start(spark, tmp_path, table_sink(table), table_sink(topic)).awaitTermination()
    stored = spark.read.parquet(table)
    assert stored.count() == 4 and stored.select("batch_id").distinct().count() == 2
    assert spark.read.parquet(topic).count() == 4
    assert stored.where("trigger_datetime_created < %d" % now).count() == 0


def test_failing_sink_fails_the_batch_and_a_rerun_leaves_one_copy(spark, tmp_path):
    folder, table, topic = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "topic")
    raw(spark, text("r1", 1, 4102444800)).coalesce(1).write.mode("append").text(folder)

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        start(spark, tmp_path, table_sink(table), broken).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    start(spark, tmp_path, table_sink(table), table_sink(topic)).awaitTermination()
    assert spark.read.parquet(table).count() == 2 and spark.read.parquet(topic).count() == 2
