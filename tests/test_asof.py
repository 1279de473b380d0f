from __future__ import annotations

import datetime as dt
import random

import pytest

from conftest import rows
from martloom.operators import loads, vault
from martloom.operators.asof import asof_lookup, join_hot
from pyspark.sql import functions as F

START = dt.datetime(2024, 1, 1)
ROWS, VERSIONS = "id int, k string, ts timestamp", "k string, at timestamp, rate int, note string"


def line(seed, n, keys):
    """Half of all rows belong to one key."""
    rng = random.Random(seed)
    return [(i, keys[0] if i % 2 else rng.choice(keys), START + dt.timedelta(hours=rng.randrange(24 * 40))) for i in range(n)]


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("span", ["hour", "day", "year"])
def test_asof_equals_brute_force_with_a_hot_key(spark, direction, span):
    asked = [*line(1, 300, ["hot", "b", "c", "none"]), (900, None, START), (901, "hot", None), (902, "hot", START - dt.timedelta(days=400))]
    known = [(k, at, i, f"n{i}") for i, k, at in line(2, 60, ["hot", "b", "c"])] + [(None, START, -1, "x"), ("b", None, -2, "x")]
    known += [("hot", START, 500, "x"), ("hot", START, 501, None)]
    got = asof_lookup(
        spark.createDataFrame(asked, ROWS), spark.createDataFrame(known, VERSIONS), ["k"], "ts", "at", ["rate", "note"], direction=direction, span=span
    )
    expected = []
    for i, k, ts in asked:
        fits = [v for v in known if k and ts and v[0] == k and v[1] and (v[1] <= ts if direction == "backward" else v[1] >= ts)]
        best = (max if direction == "backward" else min)(fits, key=lambda v: (v[1], v[2]), default=None)
        expected.append((i, k, ts, *(best[2:] if best else (None, None))))
    assert rows(got) == sorted(expected, key=repr)


def test_asof_of_nothing_and_clashing_names(spark):
    asked, known = spark.createDataFrame([(1, "a", START)], ROWS), spark.createDataFrame([], VERSIONS)
    assert rows(asof_lookup(asked, known, ["k"], "ts", "at", ["rate"])) == [(1, "a", START, None)]
    assert asof_lookup(asked.limit(0), known, ["k"], "ts", "at", ["rate"]).count() == 0
    with pytest.raises(ValueError, match="already have"):
        asof_lookup(asked, known.withColumn("id", F.lit(1)), ["k"], "ts", "at", ["id"])


def test_a_hot_key_is_met_in_several_tasks(spark):
    left = spark.createDataFrame([("hot" if i % 3 else "b", i) for i in range(90)], "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("b", 3), ("c", 4)], "k string, v int")
    assert rows(join_hot(left, right, ["k"], block_rows=10)) == rows(left.join(right, "k"))


def test_content_ids_do_not_depend_on_the_files(spark):
    data = [("x", 1)] * 40 + [("x", None), (None, 1), (None, 1), ("1", None), (None, None), ("-", 1)]
    frame = spark.createDataFrame(data, "a string, b int")
    one, other = (loads.content_id(f) for f in (frame.coalesce(1), frame.repartition(9)))
    assert rows(one) == rows(other) and one.select("row_id").distinct().count() == len(data)
    first = loads.content_id(frame.withColumn("other", F.rand()), ["a", "b"]).select("a", "b", "row_id")
    assert rows(first) == rows(one)


def test_keys_are_probed_until_they_differ(spark):
    def key(probe):
        return F.col("name") % (4 if probe == 0 else 5 if probe == 1 else 1000)

    names = spark.createDataFrame([(n,) for n in range(0, 40, 4)] + [(None,)], "name long")
    first = vault.probed_keys(names, None, "pk", ["name"], key=key)
    assert rows(first, "name", "pk")[0] == (0, 0) and first.select("pk").distinct().count() == 10 - 1 + 1
    assert rows(vault.shared_keys(names.dropna().withColumn("pk", key(0)), "pk", ["name"])) == [(0, 10)]
    assert vault.shared_keys(first, "pk", ["name"]).count() == 0
    more = names.union(spark.createDataFrame([(-4,), (1000,)], "name long"))
    later = vault.probed_keys(more, first, "pk", ["name"], key=key)
    assert {r.name for r in later.collect()} == {-4, 1000}
    unsettled = vault.probed_keys(names, None, "pk", ["name"], key=key, probes=1)
    assert unsettled.where("pk is null").count() == 9
