"""A corpus pipeline: each stage applies one operator to what the stage before has kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from martloom.llm import decontamination, exact_dedup, near_dedup, packing, queries, toxicity
from martloom.llm.common import shared_folder, stored


#: Name of the column that tells the rows of a stage's input apart, whatever their ids are.
ROW = "_pipeline_row"


def _named(docs: DataFrame) -> DataFrame:
    """The documents with their place in the stored table: 64-bit hash of the file's path, and row. Two numbers are
    carried through the operators with less memory than a path. A frame that is no table is stored first.
    """
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return docs.select(*docs.columns, place.alias(ROW))
    except AnalysisException:
        kept = stored(docs, "pipeline-input")
        return kept.select(*docs.columns, place.alias(ROW))


def _without(named: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows that are not among ``gone``: other rows of the same id stay, rows without an id can go."""
    columns = [c for c in named.columns if c != ROW]
    return named.join(gone.select(ROW).distinct(), ROW, "left_anti").select(*columns)


def _by_row(named: DataFrame) -> DataFrame:
    """The rows under an id of their own, which orders them by ``doc_id`` first."""
    return named.withColumn("doc_id", F.struct("doc_id", ROW))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    named = _named(docs)
    model = toxicity.fit(docs, queries.table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(named.withColumn("doc_id", F.col(ROW)), model)
    return _without(named, scored.where("predicted = 1").withColumnRenamed("doc_id", ROW))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row: that of the largest id."""
    named = _named(docs)
    return _without(named, exact_dedup.exact_dedup(_by_row(named)).where(~F.col("kept")).select(f"doc_id.{ROW}"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    named = _named(docs)
    return _without(named, near_dedup.near_duplicates(_by_row(named)).where(~F.col("kept")).select(f"doc_id.{ROW}"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    named = _named(docs)
    asked = named.withColumn("doc_id", F.col(ROW))
    leaks = decontamination.find_leaks(asked, queries.table(spark, sf_dir, "benchmark"))
    return _without(named, leaks.withColumnRenamed("doc_id", ROW))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences."""
    return packing.pack_documents(docs, queries.vocabulary("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: No SQL: a trained classifier, sampling and a linear program decide. The tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs, folder = queries.table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
