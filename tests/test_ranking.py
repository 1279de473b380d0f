from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from martloom.operators.ranking import first_per_key, global_ntile, global_row_number, latest_per_key, top_k


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 101, 1000])
def test_distributed_ntile_equals_window(spark, n):
    rng = random.Random(n)
    # A third of the rows share one value, as one hot metric would.
    data = [(i, 0 if i % 3 == 0 else rng.randrange(50)) for i in range(n)]
    df = spark.createDataFrame(data, "user_id long, metric long").repartition(4)
    want = df.withColumn("score", F.ntile(5).over(Window.orderBy("metric", "user_id")))
    got = global_ntile(df, {"score": "metric"}, "user_id", 5)
    assert rows(got, "user_id", "score") == rows(want, "user_id", "score")


def test_distributed_ntile_sizes_differ_by_one(spark):
    df = spark.range(1003).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("a"), F.lit(1).alias("b"))
    got = global_ntile(df, {"x": "a", "y": "b"}, "user_id", 5)
    for score in ("x", "y"):
        sizes = [r["count"] for r in got.groupBy(score).count().collect()]
        assert sorted(sizes) == [200, 200, 201, 201, 201]


def test_ntile_with_null_metric(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 1), (5, 2), (6, None)], "user_id long, metric long")
    want = df.withColumn("score", F.ntile(3).over(Window.orderBy("metric", "user_id")))
    got = global_ntile(df, {"score": "metric"}, "user_id", 3)
    assert rows(got, "user_id", "score") == rows(want, "user_id", "score")


@pytest.mark.parametrize("n", [0, 1, 5, 700])
def test_distributed_row_number_equals_window(spark, n):
    data = [(f"k{i % 9}" if i % 4 else None, i) for i in range(n)]
    df = spark.createDataFrame(data, "a string, b long").repartition(4)
    want = df.withColumn("id", F.row_number().over(Window.orderBy("a", "b")).cast("long"))
    got = global_row_number(df, ["a", "b"], "id")
    assert rows(got, "a", "b", "id") == rows(want, "a", "b", "id")


def test_rank_gate_by_count_uses_plain_window(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "a long")
    assert rows(global_row_number(df, ["a"], "id")) == [(1, 1), (2, 2), (3, 3)]


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (1, None, "c"), (2, 5, "d")], "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"]), "k", "v") == [(1, "b"), (2, "d")]
    assert rows(first_per_key(df, ["k"], [F.col("t").asc_nulls_last()]), "k", "v") == [(1, "a"), (2, "d")]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 1), (1, 1), (2, 1), (4, 0)], "k int, n int")
    assert [r["k"] for r in top_k(df, 3, [F.col("n"), F.col("k")]).collect()] == [4, 1, 2]


def test_hot_key_window_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
