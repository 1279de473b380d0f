"""As-of lookup: the version of a slowly changing table that was valid at a row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIRECTIONS = ("backward", "forward")


def asof_lookup(
    rows: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    time: str,
    version_time: str,
    columns: Sequence[str],
    *,
    direction: str = "backward",
    span: str = "day",
) -> DataFrame:
    """``rows`` with ``columns`` of the latest version of their key at or before their time; NULL without one.

    ``forward`` takes the first version at or after it. Of versions of one time the greatest by ``columns`` counts
    (forward: the least). Rows with a NULL in key or time match nothing and stay.

    One key may hold any share of the rows: its time line is cut into ranges of ``span`` (a unit of ``date_trunc``),
    which are sorted in tasks of their own. Each range is summed up as its last version, and the summaries, a row per
    key and range, carry a version over the ranges in which nothing changed.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction is one of {DIRECTIONS}")
    backward = direction == "backward"
    clash = [c for c in columns if c in rows.columns]
    if clash:
        raise ValueError(f"rows already have {clash}")
    keys = [f"_k{i}" for i in range(len(on))]
    value = F.struct(*columns)
    asked = rows.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        F.col(time).alias("_t"),
        F.lit(1 if backward else 0).alias("_side"),
        F.struct(*rows.columns).alias("_row"),
        F.lit(None).cast(versions.select(value.alias("v")).schema["v"].dataType).alias("_v"),
    )
    known = versions.dropna(subset=[*on, version_time]).select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        F.col(version_time).cast(rows.schema[time].dataType).alias("_t"),
        F.lit(0 if backward else 1).alias("_side"),
        F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"),
        value.alias("_v"),
    )
    complete = F.col("_t").isNotNull()
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    line = asked.where(complete).unionByName(known).withColumn("_range", F.date_trunc(span, "_t"))

    def nearest(window: Window, source: str) -> Column:
        pick = F.last if backward else F.first
        return pick(source, ignorenulls=True).over(window)

    # Versions of one time stand before the rows of that time, or behind them when looking forward.
    inside = Window.partitionBy(*keys, "_range").orderBy("_t", "_side", "_v")
    frame = (Window.unboundedPreceding, Window.currentRow) if backward else (Window.currentRow, Window.unboundedFollowing)
    found = line.withColumn("_own", nearest(inside.rowsBetween(*frame), "_v")).where("_row is not null")

    edge = F.max if backward else F.min
    summary = line.groupBy(*keys, "_range").agg(edge(F.when(F.col("_v").isNotNull(), F.struct("_t", "_v"))).alias("_edge"))
    ranges = Window.partitionBy(*keys).orderBy("_range")
    beyond = (Window.unboundedPreceding, -1) if backward else (1, Window.unboundedFollowing)
    carried = summary.select(*keys, "_range", nearest(ranges.rowsBetween(*beyond), "_edge").alias("_edge"))
    placed = found.join(carried, [*keys, "_range"]).select("_row", F.coalesce("_own", "_edge._v").alias("_v"))
    out = placed.unionByName(asked.where(~complete).select("_row", "_v"))
    return out.select("_row.*", *[F.col(f"_v.{c}").alias(c) for c in columns])


def join_hot(left: DataFrame, right: DataFrame, keys: Sequence[str], block_rows: int = 1_000_000) -> DataFrame:
    """Inner join on ``keys`` in which a key with many rows on the left is met in many tasks.

    A key with more than ``block_rows`` left rows is cut into blocks by a hash of the whole row; the right rows of such
    keys alone are copied to every block. Equal left rows share a block; AQE may part them further.
    """
    hot = left.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_blocks")).where("_blocks > 1")
    own = F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("_blocks")).cast("int"), F.lit(0))
    # Hot keys are few: at most one in ``block_rows`` rows.
    dealt = left.join(hot, list(keys), "left").withColumn("_block", own).drop("_blocks")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))
    copied = right.join(hot, list(keys), "left").withColumn("_block", copies).drop("_blocks")
    return dealt.join(copied, [*keys, "_block"]).drop("_block")
