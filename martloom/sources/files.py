"""File sources and sinks: CSV, Parquet, JSON pages, dated extracts, rejected rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martloom.functions.dates import as_date
from martloom.operators.loads import append, write_partitions
from martloom.plans.sales import SHIPPED, clean_increment

REJECT_COLUMN = "_corrupt_record"

# Columns of one day's order log; ``status`` is absent from older files.
ORDER_LOG_TYPES = {
    "uniq_id": "string",
    "date_time": "timestamp_ntz",
    "city_id": "int",
    "city_name": "string",
    "customer_id": "int",
    "first_name": "string",
    "last_name": "string",
    "item_id": "int",
    "item_name": "string",
    "quantity": "int",
    "payment_amount": "decimal(14,2)",
    "status": "string",
}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | str, *, sep: str = ",", header: bool = True
) -> DataFrame:
    """CSV with a declared schema: no inference pass. Integers may be empty, which gives NULL."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def read_named_csv(spark: SparkSession, path: str | list[str], types: dict[str, str], *, sep: str = ",") -> DataFrame:
    """CSV whose header decides which of the known columns a file has; files may have different headers.

    Files are read in groups of equal headers, and a column that a file lacks is NULL in its rows. Unknown columns stay
    text; a value that does not fit its type becomes NULL.
    """
    first = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    lines = first.withColumn("line", F.monotonically_increasing_id()).where("at = 0")
    # The least line number is kept in place, line by line; a text would have all lines of a block sorted by file first. A row a file is sent around, as it is to the driver.
    tops = lines.groupBy("file").agg(F.min("line").alias("line"))
    heads = lines.join(F.broadcast(tops), ["file", "line"]).select("file", F.col("value").alias("header"))
    groups = heads.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    raw: DataFrame | None = None
    for group in sorted(groups, key=lambda g: g["header"]):
        files = [unquote(f) for f in group["files"]]
        rows = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False).csv(files)
        raw = rows if raw is None else raw.unionByName(rows, allowMissingColumns=True)
    if raw is None:
        raw = spark.read.option("header", True).option("sep", sep).csv(path)
    return raw.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def ingest_increment(spark: SparkSession, path: str, ds: str | dt.date, sep: str = ",") -> DataFrame:
    """One day's order log, cleaned. ``path`` holds ``{ds}`` where the day goes."""
    raw = read_named_csv(spark, path.format(ds=as_date(ds).isoformat()), ORDER_LOG_TYPES, sep=sep)
    order = ["date_time", *[c for c in raw.columns if c != "date_time"]]
    rows = clean_increment(raw, [F.col(c).asc_nulls_last() for c in order])
    return rows.withColumn("status", F.coalesce("status", F.lit(SHIPPED)))


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_document_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed API pages, each file line a JSON array of documents, as one row per document.

    ``object_value`` is the document text; ``arrival`` orders documents by file time and
    position on the page.
    """
    return _documents(spark.read.text(path))


def read_document_page_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int = 100) -> DataFrame:
    """The same as a stream over a folder in which pages land; every trigger takes a bounded number of files.

    Which files were read is kept in the query's checkpoint, so a query that is stopped and started again reads each
    page once, and pages that land meanwhile are not missed. Files must appear whole and keep their names.
    """
    return _documents(spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path))


def _documents(lines: DataFrame) -> DataFrame:
    file = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    pages = lines.select("value", file[0].alias("_at"), file[1].alias("_file"))
    texts = F.from_json("value", "array<string>")
    docs = pages.select("_at", "_file", F.posexplode(texts).alias("_pos", "object_value"))
    place = F.lpad(F.col("_pos").cast("string"), 9, "0")
    arrival = F.concat_ws("#", F.date_format("_at", "yyyyMMddHHmmssSSS"), "_file", place)
    return docs.where("object_value is not null").select("object_value", arrival.alias("arrival"))


def load_with_rejects(
    spark: SparkSession, path: str | list[str], schema: StructType, *, sep: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """Headerless CSV as (good rows, rejected lines).

    A line is rejected for a value of the wrong type or for too few or too many fields. Lines
    are parsed by an expression over text, so every column is checked whichever columns are
    used later, and no cache is needed.
    """
    lines = spark.read.text(path)
    checked = StructType([*schema.fields, StructField(REJECT_COLUMN, StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN}
    quoted = {f.name: "`" + f.name.replace("`", "``") + "`" for f in checked.fields}
    ddl = ", ".join(f"{quoted[f.name]} {f.dataType.simpleString()}" for f in checked.fields)
    parsed = lines.select("value", F.from_csv("value", ddl, options).alias("_row"))
    rejected = F.col(f"_row.{REJECT_COLUMN}").isNotNull()
    good = parsed.where(~rejected).select(*[F.col(f"_row.{quoted[f.name]}") for f in schema.fields])
    return good, parsed.where(rejected).select(F.col("value").alias("line"))


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """First rows for a look at a file."""
    return df.limit(rows)


def write_csv_extract(df: DataFrame, folder: str, name: str, ds: str | dt.date, sep: str = ";") -> str:
    """Headerless dated extract ``{folder}/{name}_{ds}``; a directory with a file per task."""
    target = f"{folder}/{name}_{as_date(ds).isoformat()}"
    df.write.mode("overwrite").option("sep", sep).option("header", False).csv(target)
    return target


def write_dated(df: DataFrame, path: str, ds: str | dt.date) -> None:
    """Parquet under ``date=ds``; a second run of the day replaces it."""
    write_partitions(df.withColumn("date", F.lit(as_date(ds))), path, ["date"])


def append_staging(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Append to a staging table, which is a table like any other."""
    append(df, path, partition_cols)
