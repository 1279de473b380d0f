"""Loads: upserts, counters, new rows, increments, marks, period replacement."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from martloom.functions.keys import as_column
from martloom.operators import snapshots
from martloom.operators.ranking import global_row_number, group_row_number, latest_per_key


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """Existing rows with the incoming ones laid over them; the last by ``order_by`` wins per key.

    Incoming rows beat existing ones. Columns in ``keep_first`` hold the value of the first
    load (for example the first load time of a hub row).
    """
    merged = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    if not keep_first:
        return latest_per_key(merged, keys, ["_new", *order_by]).drop("_new")
    age = F.struct("_new", *order_by)
    rest = [c for c in existing.columns if c not in keys]
    packed = merged.groupBy(*keys).agg(
        F.max_by(F.struct(*[c for c in rest if c not in keep_first]), age).alias("_last"),
        F.min_by(F.struct(*keep_first), age).alias("_first"),
    )
    columns = [
        F.col(c) if c in keys else F.col(f"_first.{c}" if c in keep_first else f"_last.{c}") for c in existing.columns
    ]
    return packed.select(*columns)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Storage bucket of a key, the partition column of upserted tables."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Parquet table at ``path``, or no rows with the same columns when nothing was written yet."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def upsert_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: int,
    keep_first: Sequence[str] = (),
) -> None:
    """Upsert into a table of key buckets that ``read_upserted`` reads.

    Only buckets that receive rows are read and rewritten, into new folders; a manifest then makes all of them count at
    once. A run that stops anywhere leaves the table as it was or as it shall be, and repeating the call gives the same
    table. ``buckets`` must stay the same for a table; aim at files of some hundred MB per bucket. Replaced folders
    stay until ``snapshots.expire``.
    """
    incoming = incoming.withColumn("bucket", key_bucket(keys, buckets))
    # At most ``buckets`` numbers: they prune the read to the folders that change.
    touched = {row["bucket"] for row in incoming.select("bucket").distinct().collect()}
    if not touched:
        return
    version, parts = snapshots.newest(spark, path)
    existing = snapshots.read_parts(spark, path, [p for p in parts if p.low in touched], incoming.schema)
    merged = upsert(existing, incoming, ["bucket", *keys], order_by, keep_first)
    folder = snapshots.write_data(balanced(merged, ["bucket"]), path, ["bucket"])
    fresh = [snapshots.Part(f"{folder}/bucket={b}", 0, b, b) for b in sorted(touched)]
    snapshots.commit(spark, path, version, [p for p in parts if p.low not in touched] + fresh)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole state of an upserted table."""
    return snapshots.read_table(spark, path).drop("bucket")


def add_counts(
    existing: DataFrame, delta: DataFrame, keys: Sequence[str], count: str, names: Sequence[str] = ()
) -> DataFrame:
    """Counters plus new counts per key; ``names`` are refreshed from the new rows.

    Both sides may repeat a key; NULL key parts are equal. Of several new names the greatest is taken.
    """
    columns = [*keys, *names, count]
    both = existing.select(*columns, F.lit(False).alias("_new")).unionByName(
        delta.select(*columns, F.lit(True).alias("_new"))
    )
    fresh = {n: F.max(F.when(F.col("_new"), F.col(n))) for n in names}
    kept = {n: F.max(F.when(~F.col("_new"), F.col(n))) for n in names}
    return both.groupBy(*keys).agg(
        *[F.coalesce(fresh[n], kept[n]).alias(n) for n in names],
        F.sum(F.coalesce(count, F.lit(0))).alias(count),
    )


def new_rows(src: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target.

    A key with a NULL part is never loaded, and a NULL in the target hides nothing: the meaning
    callers expect of NOT IN, without its NULL trap.
    """
    return src.dropna(subset=list(keys)).join(target.select(*keys), list(keys), "left_anti")


def null_key_rows(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows ``new_rows`` leaves out for a NULL key part."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return src.where(missing)


def increment(src: DataFrame, mark_col: str, after: object, limit: int | None = None) -> DataFrame:
    """Rows past the mark; with ``limit`` the first page in mark order, with all rows tied on its last mark.

    The next page starts past that mark, so a tie is never cut.
    """
    rows = src.where(F.col(mark_col) > F.lit(after))
    if limit is None:
        return rows
    last = rows.select(mark_col).orderBy(mark_col).limit(limit).agg(F.max(mark_col).alias("last"))
    return rows.where(F.col(mark_col) <= last.scalar()).orderBy(mark_col)


def next_mark(rows: DataFrame, mark_col: str) -> DataFrame:
    """One row with the new mark, NULL if the page was empty."""
    return rows.agg(F.max(mark_col).alias("mark"))


def page_after(src: DataFrame, cursor: Sequence[str], after: Sequence[object] | None, limit: int | None = None) -> DataFrame:
    """Rows past a compound cursor in its order; with ``limit`` the first so many.

    ``cursor`` ends in a unique column, so that a page may end between rows that share the leading mark; none of its
    columns is NULL. ``after`` holds one value a column, as text or in its own type, or None for the beginning. The
    condition on the leading column reaches the scan.
    """
    rows = src
    if after is not None:
        marks = [F.lit(v).cast(src.schema[c].dataType) for c, v in zip(cursor, after, strict=True)]
        past = F.lit(False)
        for name, mark in reversed(list(zip(cursor, marks, strict=True))):
            past = (F.col(name) > mark) | ((F.col(name) == mark) & past)
        rows = rows.where((F.col(cursor[0]) >= marks[0]) & past)
    return rows if limit is None else rows.orderBy(*cursor).limit(limit)


def next_cursor(rows: DataFrame, cursor: Sequence[str]) -> DataFrame:
    """One row with the cursor of the page's last row as an array of texts, NULL if the page was empty."""
    last = rows.agg(F.max(F.struct(*cursor)).alias("_last"))
    texts = F.array(*[F.col(f"_last.{c}").cast("string") for c in cursor])
    return last.select(F.when(F.col("_last").isNotNull(), texts).alias("cursor"))


MARK_SCHEMA = "mark string, saved_at timestamp, workflow string"


def read_mark(spark: SparkSession, path: str, workflow: str, default: str | None = None) -> str | None:
    """Saved mark of a workflow as text."""
    empty = spark.createDataFrame([], MARK_SCHEMA)
    row = read_or_empty(spark, path, empty).where(F.col("workflow") == workflow).select("mark").first()
    return default if row is None else row["mark"]


def write_mark(spark: SparkSession, path: str, workflow: str, mark: object, saved_at: object) -> None:
    """Save a workflow's mark; other workflows in the same table are not touched."""
    row = spark.createDataFrame([(None if mark is None else str(mark), saved_at, workflow)], MARK_SCHEMA)
    write_partitions(row.coalesce(1), path, ["workflow"])


def read_cursor(spark: SparkSession, path: str, workflow: str) -> list[str] | None:
    """Saved cursor of a workflow as texts, None before the first."""
    text = read_mark(spark, path, workflow)
    return None if text is None else json.loads(text)


def write_cursor(spark: SparkSession, path: str, workflow: str, cursor: Sequence[str] | None, saved_at: object) -> None:
    """Save all columns of a cursor as one mark, so that they never part; an empty page keeps the saved one."""
    if cursor is not None:
        write_mark(spark, path, workflow, json.dumps(list(cursor)), saved_at)


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], codec: str | None = None) -> None:
    """Overwrite exactly the partitions present in ``df``."""
    writer = df.write.option("compression", codec) if codec else df.write
    (
        writer.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def replace_period(df: DataFrame, path: str, period_cols: Sequence[str]) -> None:
    """Delete and insert the periods of ``df``; running it twice leaves one copy."""
    write_partitions(balanced(df, period_cols), path, period_cols)


def balanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows brought together per table partition before a write.

    The rebalance hint lets Spark cut a partition that holds many rows into several tasks and
    put small ones together, so neither tiny files nor one huge task come about.
    """
    return df.hint("rebalance", *partition_cols)


def ensure_column(df: DataFrame, name: str, data_type: str, default: object) -> DataFrame:
    """Add a column with a default where it is missing; rows that have it keep their value."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(data_type))


def update_from(target: DataFrame, src: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set columns of the target from matching source rows; of several for a key the greatest counts."""
    once = src.groupBy(*on).agg(F.max(F.struct(*columns)).alias("_new"))
    new = once.select(*on, *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in columns])
    joined = target.join(new, list(on), "left")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns]
    )


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Append rows to a Parquet table."""
    df.write.mode("append").partitionBy(*partition_cols).parquet(path)


def surrogate_id(df: DataFrame, order_by: Sequence[str], name: str = "id", start_after: int = 0) -> DataFrame:
    """Serial ids in a fixed order, continuing after ``start_after``."""
    numbered = global_row_number(df, order_by, name)
    return numbered.withColumn(name, F.col(name) + F.lit(start_after)) if start_after else numbered


def with_row_id(df: DataFrame, name: str = "event_id") -> DataFrame:
    """Unique id for rows without a key. It changes from run to run: never store or join on it."""
    return df.withColumn(name, F.monotonically_increasing_id())


def content_id(df: DataFrame, columns: Sequence[str] | None = None, name: str = "row_id") -> DataFrame:
    """Id for rows without a key that is the same in every run: digest of the content, and a number among equal rows.

    ``columns`` (default: all) identify a row. Rows that are equal in them are told apart by a number from 1 on, so the
    ids of a table do not depend on how its files are split or read. A NULL differs from every value.
    """
    parts: list[Column] = []
    for c in columns or df.columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    digested = df.withColumn("_digest", F.md5(F.concat(*parts)))
    numbered = group_row_number(digested, ["_digest"], [c for c in df.columns if c in (columns or df.columns)], "_number")
    return numbered.select(*df.columns, F.concat_ws("-", "_digest", "_number").alias(name))


def with_literals(df: DataFrame, **values: object) -> DataFrame:
    """Constant columns such as load time and source."""
    return df.withColumns({name: as_column(F.lit(value)) for name, value in values.items()})
