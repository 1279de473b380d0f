from __future__ import annotations

import datetime as dt

import pytest

from conftest import rows
from martloom.operators import loads, snapshots


def test_upsert_last_write_wins_and_keeps_first(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, load int")
    new = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 2)], "k int, v string, load int")
    assert rows(loads.upsert(old, new, ["k"], ["load"])) == [(1, "a", 1), (2, "d", 3), (3, "e", 2)]
    kept = loads.upsert(old, new, ["k"], ["load"], keep_first=["load"])
    assert rows(kept) == [(1, "a", 1), (2, "d", 1), (3, "e", 2)]


def test_upsert_table_twice_gives_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(k, "a", 1) for k in range(40)], "k int, v string, t int")
    second = spark.createDataFrame([(k, "b", 2) for k in range(30, 50)], "k int, v string, t int")
    loads.upsert_table(spark, path, first, ["k"], ["t"], buckets=8)
    loads.upsert_table(spark, path, second, ["k"], ["t"], buckets=8)
    once = rows(loads.read_upserted(spark, path), "k", "v")
    loads.upsert_table(spark, path, second, ["k"], ["t"], buckets=8)
    assert rows(loads.read_upserted(spark, path), "k", "v") == once
    assert sorted(once) == sorted([(k, "a") for k in range(30)] + [(k, "b") for k in range(30, 50)])


def test_upsert_table_leaves_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.upsert_table(spark, path, spark.range(100), ["id"], ["id"], buckets=8)
    before = {p.low: p.folder for p in snapshots.newest(spark, path)[1]}
    loads.upsert_table(spark, path, spark.range(1), ["id"], ["id"], buckets=8)
    after = {p.low: p.folder for p in snapshots.newest(spark, path)[1]}
    assert sum(before[b] != after[b] for b in before) == 1
    loads.upsert_table(spark, path, spark.range(0), ["id"], ["id"], buckets=8)
    assert snapshots.newest(spark, path)[0] == 2


@pytest.mark.parametrize("step", ["write_data", "commit"])
def test_an_upsert_cut_off_at_any_step_leaves_the_old_state(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(k, "a", 1) for k in range(20)], "k int, v string, t int")
    second = spark.createDataFrame([(k, "b", 2) for k in range(10, 30)], "k int, v string, t int")
    args = (["k"], ["t"], 4)
    loads.upsert_table(spark, path, first, *args)
    whole = getattr(snapshots, step)

    def cut_off(*given, **named):
        if step == "write_data":
            whole(*given, **named)  # all data is there, and still does not count
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, step, cut_off)
    with pytest.raises(KeyboardInterrupt):
        loads.upsert_table(spark, path, second, *args)
    monkeypatch.setattr(snapshots, step, whole)
    assert rows(loads.read_upserted(spark, path), "k", "v") == sorted([(k, "a") for k in range(20)], key=repr)
    loads.upsert_table(spark, path, second, *args)
    assert rows(loads.read_upserted(spark, path), "k", "v") == sorted([(k, "a") for k in range(10)] + [(k, "b") for k in range(10, 30)], key=repr)
    used = {p.folder.split("/")[1] for p in snapshots.newest(spark, path)[1]}
    snapshots.expire(spark, path, dt.datetime.now() - dt.timedelta(days=1))
    assert len(list((tmp_path / "t/manifests").glob("version=*"))) == 2
    snapshots.expire(spark, path, dt.datetime.now() + dt.timedelta(days=1))
    assert {p.name for p in (tmp_path / "t/data").iterdir()} == used
    assert loads.read_upserted(spark, path).count() == 30


def test_two_writers_of_one_version_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.upsert_table(spark, path, spark.range(3), ["id"], ["id"], buckets=2)
    for _ in range(2):
        snapshots.commit(spark, path, 1, snapshots.newest(spark, path)[1] if _ == 0 else [])
    with pytest.raises(RuntimeError, match="two writers"):
        snapshots.newest(spark, path)


def test_add_counts(spark):
    old = spark.createDataFrame([(1, "old", 5), (2, "x", 1)], "k int, name string, n long")
    new = spark.createDataFrame([(1, "new", 2), (3, "y", 4)], "k int, name string, n long")
    assert rows(loads.add_counts(old, new, ["k"], "n", ["name"])) == [(1, "new", 7), (2, "x", 1), (3, "y", 4)]


def test_new_rows_is_not_fooled_by_nulls(spark):
    src = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(loads.new_rows(src, dim, ["k"])) == [(2,)]
    assert loads.null_key_rows(src, ["k"]).count() == 1


def test_increment_pages_in_order(spark):
    src = spark.range(500).repartition(4)
    page = loads.increment(src, "id", 99, limit=100)
    assert [r["id"] for r in page.collect()] == list(range(100, 200))
    assert loads.next_mark(page, "id").first()["mark"] == 199
    assert loads.next_mark(loads.increment(src, "id", 1000), "id").first()["mark"] is None


def test_marks_are_kept_per_workflow(spark, tmp_path):
    path = str(tmp_path / "marks")
    now = dt.datetime(2024, 1, 1)
    assert loads.read_mark(spark, path, "a", default="-1") == "-1"
    loads.write_mark(spark, path, "a", 5, now)
    loads.write_mark(spark, path, "b", 7, now)
    loads.write_mark(spark, path, "a", 9, now)
    assert (loads.read_mark(spark, path, "a"), loads.read_mark(spark, path, "b")) == ("9", "7")


def test_replace_period_is_safe_to_repeat(spark, tmp_path):
    path = str(tmp_path / "t")
    week = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "week int, v int")
    loads.replace_period(week, path, ["week"])
    for _ in range(2):
        loads.replace_period(spark.createDataFrame([(1, 99)], "week int, v int"), path, ["week"])
    assert rows(spark.read.parquet(path), "week", "v") == [(1, 99), (2, 20)]


def test_ensure_column_and_update_from(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert rows(loads.ensure_column(df, "status", "string", "shipped"), "k", "status") == [(1, "shipped"), (2, "shipped")]
    assert loads.ensure_column(df, "v", "string", "z").columns == ["k", "v"]
    new = spark.createDataFrame([(2, "new")], "k int, v string")
    assert rows(loads.update_from(df, new, ["k"], ["v"])) == [(1, "x"), (2, "new")]


def test_row_ids_are_unique(spark):
    df = loads.with_row_id(spark.range(100).repartition(4))
    assert df.select("event_id").distinct().count() == 100


def test_append(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.append(spark.range(3), path)
    loads.append(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5


def test_pages_keep_rows_tied_on_the_mark(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "mark int, name string")
    seen, mark = [], 0
    while mark is not None:
        page = loads.increment(src, "mark", mark, 2)
        seen += [r.name for r in page.collect()]
        mark = loads.next_mark(page, "mark").first()["mark"]
    assert sorted(seen) == ["a", "b", "c", "d"]


def test_add_counts_with_null_and_repeated_keys(spark):
    old = spark.createDataFrame([("u", 1), (None, 2)], "k string, n long")
    new = spark.createDataFrame([("u", 2), ("u", 3), (None, 1)], "k string, n long")
    assert rows(loads.add_counts(old, new, ["k"], "n")) == sorted([("u", 6), (None, 3)], key=repr)


def test_update_from_a_repeated_source_key(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    src = spark.createDataFrame([(1, "p"), (1, "q")], "k int, v string")
    assert rows(loads.update_from(target, src, ["k"], ["v"])) == [(1, "q"), (2, "y")]
