from __future__ import annotations

import datetime as dt

import pytest

from conftest import rows
from martloom.sources import files
from martloom.streaming import compaction, seen
from martloom.streaming.sinks import table_sink

SCHEMA = "object_id string, user_id string, product_id string, product_name string, ts timestamp"
DAY = dt.datetime(2024, 1, 1)


def items(spark, *given):
    return spark.createDataFrame([(i, "u", "p", f"n{d}", None if d is None else DAY + dt.timedelta(days=d)) for i, d in given], SCHEMA)


def test_late_and_replayed_ids_count_once(spark, tmp_path):
    path = str(tmp_path / "seen")

    def fresh(batch_id, *given):
        return rows(seen.first_seen(items(spark, *given), batch_id, path, "object_id", "ts"), "object_id")

    assert fresh(0, ("a", 0), ("a", 0), ("b", 1), ("x", None)) == [("a",), ("b",), ("x",)]
    # A repeat that is days late, a late row that is new, a repeat without a time, and no id at all.
    assert fresh(1, ("a", 0), ("c", 0), ("d", 9), ("x", None), (None, 0)) == [("c",), ("d",)]
    assert fresh(1, ("a", 0), ("c", 0), ("d", 9), ("x", None), (None, 0)) == [("c",), ("d",)]
    assert fresh(2, ("c", 0), ("d", 9)) == []


def test_a_batch_reads_the_periods_of_its_rows_only(spark, tmp_path, monkeypatch):
    path, asked = str(tmp_path / "seen"), []
    whole = seen.part_paths
    for n in range(12):
        seen.first_seen(items(spark, (f"i{n}", n), (f"j{n}", 0)), n, path, "object_id", "ts")
    monkeypatch.setattr(seen, "part_paths", lambda s, p, before: asked.append(p) or whole(s, p, before))
    assert rows(seen.first_seen(items(spark, ("i11", 11), ("new", 11)), 12, path, "object_id", "ts"), "object_id") == [("new",)]
    assert [p.split("period=")[1] for p in asked] == ["2024011200"]
    first = f"{path}/period=2024010100"
    seen.compact_seen(spark, path, ["2024010100"], "object_id", fan_in=3)
    assert len(whole(spark, first, 13)) <= 6
    compaction.drop_merged(spark, first, dt.datetime.now() + dt.timedelta(days=1))
    assert rows(seen.first_seen(items(spark, ("j0", 0), ("j7", 0), ("k", 0)), 13, path, "object_id", "ts"), "object_id") == [("k",)]


def test_counters_survive_replays_compaction_and_a_repeated_batch(spark, tmp_path):
    path, names = str(tmp_path / "out"), ("product_id", "product_name")
    batches = [[("a", 0), ("b", 1)], [("a", 0), ("c", 5)], [("d", 2)], [("e", 3), ("b", 1)], [("f", 4)]]

    def deliver(fresh, batch_id):
        last = fresh.groupBy("user_id", "product_id").agg({"ts": "max"}).withColumnRenamed("max(ts)", "last_ts")
        table_sink(path)(seen.user_counters(fresh, *names, ["ts"]).join(last, ["user_id", "product_id"]), batch_id)

    sink = seen.once_sink(path + "-seen", "object_id", "ts", deliver)
    for n, given in enumerate(batches):
        for _ in range(2):
            sink(items(spark, *given), n)
        assert seen.compact_counters(spark, path, *names, fan_in=2) <= 2
    assert rows(seen.current_counters(spark, path, *names)) == [("u", "p", "n5", 6)]


def test_page_stream_reads_each_page_once_across_restarts(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    batches = []

    def run():
        docs = files.read_document_page_stream(spark, str(landing), max_files_per_trigger=2)
        writer = docs.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint"))
        sink = writer.foreachBatch(lambda batch, _: batches.append(sorted(r.object_value for r in batch.collect())))
        sink.trigger(availableNow=True).start().awaitTermination()

    for n in range(5):
        (landing / f"p{n}.json").write_text(f'[{{"id":{n}}},{{"id":{n + 10}}}]\n')
    run()
    assert len(batches) == 3 and all(len(b) <= 4 for b in batches)
    run()
    (landing / "p9.json").write_text('[{"id":99}]\n')
    run()
    assert len(batches) == 4 and batches[3] == ['{"id":99}']
    assert sorted(d for b in batches for d in b) == sorted([f'{{"id":{n}}}' for n in (*range(5), *range(10, 15), 99)])


def test_files_of_different_headers_are_read_at_once(spark, tmp_path):
    folder = tmp_path / "day one"
    folder.mkdir()
    (folder / "a.csv").write_text("id,amount\n1,2.5\n2,x\n")
    (folder / "b.csv").write_text("id,status,amount\n3,done,4\n")
    (folder / "c.csv").write_text("amount,id\n7,8\n")
    got = files.read_named_csv(spark, str(folder), {"id": "int", "amount": "double"})
    assert rows(got, "id", "amount", "status") == sorted(
        [(1, 2.5, None), (2, None, None), (3, 4.0, "done"), (8, 7.0, None)], key=repr
    )
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.read_named_csv(spark, str(tmp_path / "none"), {}).count()
