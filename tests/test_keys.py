from __future__ import annotations

import uuid

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.functions.keys import hash_diff, hash_key, md5_key, uuid3_key, with_uuid3

TEXTS = ["", "a", "заказ", "ab c", "x" * 500, "1234567890", "é́", "\U0001f600"]


def test_uuid3_equals_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "name string")
    got = {r["name"]: r["key"] for r in df.withColumn("key", uuid3_key("name")).collect()}
    assert got == {t: str(uuid.uuid3(uuid.NAMESPACE_X500, t)) for t in TEXTS}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"])), min_size=1, max_size=100))
def test_uuid3_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "name string").select("name", uuid3_key("name").alias("key"))
    for r in df.collect():
        assert r["key"] == str(uuid.uuid3(uuid.NAMESPACE_X500, r["name"]))


def test_uuid3_of_null_is_null(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(uuid3_key("a", "b").alias("k")).first()["k"] is None


def test_keys_over_an_aggregate_compute_each_digest_once(spark):
    texts = spark.createDataFrame([(t, "x") for t in TEXTS], "name string, other string").distinct()
    keyed = with_uuid3(with_uuid3(texts, {"key": ["name"]}), {"both": ["key", "other"]})
    for r in keyed.collect():
        assert r["key"] == str(uuid.uuid3(uuid.NAMESPACE_X500, r["name"]))
        assert r["both"] == str(uuid.uuid3(uuid.NAMESPACE_X500, r["key"] + "x"))
    assert keyed.columns == ["name", "other", "key", "both"]
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 2


def test_hash_diff_joins_without_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    plain = df.select(hash_diff("a", "b").alias("k")).distinct().count()
    apart = df.select(hash_diff("a", "b", sep="|").alias("k")).distinct().count()
    assert (plain, apart) == (1, 2)


def test_null_positions_give_different_keys(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1)], "a int, b int")
    for key in (hash_key, md5_key):
        assert df.select(key("a", "b").alias("k")).distinct().count() == 3
    assert df.select(F.xxhash64("a", "b").alias("k")).limit(2).distinct().count() == 1


def test_keys_differ_from_joined_neighbours(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    assert len(set(rows(df.select(hash_key("a", "b"))))) == 2
