"""Helpers shared by the operators: shared-folder tables, text batches and seeded hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.sources.folders import delete_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a temporary one only in local mode where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder or tempfile.mkdtemp(prefix="llm-")


def stored(frame: DataFrame, name: str, keys: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """``frame`` written to the shared folder and read back: later stages start from files, not from lineage."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = frame.write.option("compression", codec) if codec else frame.write
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
    kept = spark.read.schema(frame.schema).parquet(path)
    kept.stored_at = path
    return kept


def dropped(*frames: DataFrame) -> None:
    """Delete the files of frames that ``stored`` gave and that nothing reads any more."""
    for frame in frames:
        delete_folder(frame.sparkSession, frame.stored_at)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null"))) % folds


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that a task holds few whole texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser over unsigned 64-bit integers; equal seeds give equal results in every task."""
    with np.errstate(over="ignore"):
        x = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_DICE = np.random.default_rng(31)
_BYTES = _DICE.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = _DICE.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTES[_BLANK] = 0


def word_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, and where each text's words begin (and the last end).

    Words are runs between blanks and tab to carriage return. A word's hash is the sum over its bytes of a random
    number of the byte times one of its place in the word.
    """
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    raw = np.frombuffer(b" " + b" ".join(parts), np.uint8)
    blank = _BLANK.take(raw)
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    offsets = np.cumsum([1, *(len(p) + 1 for p in parts)])
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    raw = raw[starts[0] :]
    starts = starts - starts[0]
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
    with np.errstate(over="ignore"):
        terms = _BYTES.take(raw)
        if place.max() < 256:
            terms *= _PLACES.take(place)
        else:
            terms *= _PLACES.take(place & 255) + (place >> 8).astype(np.uint64)
        return mix(np.add.reduceat(terms, starts)), bounds


def shingle_table(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of all texts, and where each text's runs begin (and the last end)."""
    ids, bounds = word_table(texts)
    every = shingle_hashes(ids, width)
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    ends = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], counts)
    return every[at], ends


def shingle_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words, in text order; none where the text is shorter."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for i in range(width):
            h = h * np.uint64(0x100000001B3) + mix(ids[i : i + n], i)
    return mix(h)
