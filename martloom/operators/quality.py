"""Data-quality checks. Each returns a report or the rows that break the rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``total`` rows and ``uniq`` distinct keys.

    Counted in two steps so that every task counts some keys; a key with a NULL part is not
    counted as distinct.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"), F.count_if(complete).alias("uniq")
    )


def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "missing")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    return df.where(missing)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. NULL parts never clash."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    )


def check_range(df: DataFrame, col: str, low: object = None, high: object = None) -> DataFrame:
    """Rows outside [low, high]. NULL passes, as in a CHECK constraint."""
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(col) < F.lit(low))
    if high is not None:
        broken = broken | (F.col(col) > F.lit(high))
    return df.where(broken)


def check_expr(df: DataFrame, name: str, rule: str | Column) -> DataFrame:
    """Rows for which the rule is false, labelled with its name. NULL passes."""
    condition = F.expr(rule) if isinstance(rule, str) else rule
    return df.where(~condition).withColumn("rule", F.lit(name))


def check_fk(child: DataFrame, parent: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Missing parents: child keys without a parent and how many rows use each.

    ``columns`` maps child to parent columns. Child rows are counted per key before the join.
    """
    keys = list(columns)
    used = child.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("orphans"))
    known = parent.select(*[F.col(p).alias(c) for c, p in columns.items()])
    return used.join(known, keys, "left_anti")
