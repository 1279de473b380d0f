"""Named queries over a folder of test tables, with their SQL."""

from __future__ import annotations

import importlib
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import BY_SIZE

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
MODULES = [
    "rfm",
    "shipping",
    "sales",
    "courier",
    "groups",
    "geo",
    "campaign",
    "orders",
    "currency",
    "quality",
    "storage",
    "streams",
]


class Tables:
    """Test tables of one folder by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        for name, value in BY_SIZE.items():
            spark.conf.set(name, value)
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")



    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """A table that later steps read several times, written once as a pipeline would."""
        path = scratch_folder(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under a name, with its SQL where there is one."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"martloom.bindings.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def money(c: str | Column) -> Column:
    """Exact money from a double column with cents."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(14,2)")


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: 64-bit integers, doubles, text for dates, times and arrays."""
    shown = []
    for field in df.schema.fields:
        kind, c = field.dataType.simpleString(), F.col(field.name)
        if kind in ("int", "smallint", "tinyint"):
            c = c.cast("long")
        elif kind.startswith("decimal") or kind == "float":
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind.startswith("array"):
            c = F.concat_ws(",", c)
        shown.append(c.alias(field.name))
    return df.select(*shown)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """New folder beside the checkpoints for queries that write and read back."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return os.path.join(root, f"martloom-{name}-{uuid.uuid4().hex}")
