"""Changes between two snapshots of a table, and rows that wait for a partner."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import as_column


def row_digest(columns: Sequence[str | Column]) -> list[Column]:
    """Two 64-bit hashes of a row's values; a NULL differs from every value and from a missing column beside it."""
    parts: list[Column] = []
    for c in columns:
        parts += [as_column(c).isNull(), as_column(c)]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, change): ``insert``, ``update`` or ``delete`` for each key whose row is not the same in both snapshots.

    Only keys and hashes are shuffled. Keys are unique within a snapshot; NULL key parts are equal.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        low, high = row_digest(columns)
        return rows.select(*keys, F.lit(name).alias("_side"), low.alias("_low"), high.alias("_high"))

    was, now = F.col("_side") == "old", F.col("_side") == "new"
    both = side(old, "old").unionByName(side(new, "new")).groupBy(*keys).agg(
        *[F.max(F.when(which, F.col(h))).alias(f"{n}{h}") for n, which in (("was", was), ("now", now)) for h in ("_low", "_high")]
    )
    same = (F.col("was_low") == F.col("now_low")) & (F.col("was_high") == F.col("now_high"))
    kind = (
        F.when(F.col("was_low").isNull(), F.lit("insert"))
        .when(F.col("now_low").isNull(), F.lit("delete"))
        .when(~same, F.lit("update"))
    )
    return both.select(*keys, kind.alias("change")).where("change is not null")


def capture_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the new snapshot that were inserted or updated and of the old one that were deleted, with ``change``.

    ``columns`` are compared (default: all but the keys). The old snapshot needs the same columns. Changed keys are
    found by hashes first; whole rows are read again for these alone.
    """
    compared = [c for c in new.columns if c not in keys] if columns is None else list(columns)
    found = changed_keys(old, new, keys, compared)
    out = []
    for rows, kinds in ((new, ("insert", "update")), (old, ("delete",))):
        wanted = found.where(F.col("change").isin(*kinds)).select(*[F.col(k).alias(f"_{k}") for k in keys], "change")
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        out.append(rows.join(wanted, same).select(*new.columns, "change"))
    return out[0].unionByName(out[1])


def with_waiting(fresh: DataFrame, waiting: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Fresh rows and those that wait since earlier runs, with ``waiting_since`` (NULL for fresh ones).

    A fresh version of a waiting row takes its place and keeps the time since which its key waits.
    """
    rows = fresh.withColumn("waiting_since", F.lit(None).cast("timestamp"))
    if waiting is None:
        return rows
    newer = waiting.join(fresh.select(*keys).distinct(), list(keys), "left_anti")
    since = waiting.groupBy(*keys).agg(F.min("waiting_since").alias("waiting_since"))
    kept = rows.drop("waiting_since").join(since, list(keys), "left").select(*rows.columns)
    return kept.unionByName(newer)


def still_waiting(candidates: DataFrame, loaded: DataFrame, keys: Sequence[str], now: dt.datetime | Column) -> DataFrame:
    """Candidates of which no row was loaded: the next run's ``waiting``. Their waiting time starts ``now`` if it has not."""
    left = candidates.join(loaded.select(*keys).distinct(), list(keys), "left_anti")
    return left.withColumn("waiting_since", F.coalesce("waiting_since", as_column(F.lit(now)).cast("timestamp")))


def overdue(waiting: DataFrame, now: dt.datetime | Column, max_days: int) -> tuple[DataFrame, DataFrame]:
    """Waiting rows parted into those to try again and those that wait longer than ``max_days``: bounded, and reported."""
    late = F.col("waiting_since") < as_column(F.lit(now)).cast("timestamp") - F.make_dt_interval(F.lit(max_days))
    return waiting.where(~late), waiting.where(late)
