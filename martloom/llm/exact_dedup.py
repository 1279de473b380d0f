"""Exact deduplication over an extendible-hash index, in DataFrame operations only.

Texts meet by a 64-bit key. A directory over the leading bits of the keys comes first: it doubles until no bucket holds
more than ``capacity`` keys (or ``depth_limit`` bits are used; such a bucket simply stays larger). Then the texts are
dealt to their buckets, where equal ones are told by their bytes and become one link each; owner tasks take ranges of
buckets and keys, chain the links of different texts that share a key, and write the index to shared files. A document
finds its link through its slot of the directory, the bucket, the key and the chain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import lower_ascii, stored, whole_text

DEPTH_LIMIT = 16
CAPACITY = 4096


def _slot(depth_limit: int) -> Column:
    return F.shiftrightunsigned("key", 64 - depth_limit).alias("slot")


def _keyed(docs: DataFrame, key_of: Callable[[Column], Column]) -> DataFrame:
    """The documents' normalised texts with their key."""
    return docs.select("doc_id", lower_ascii(whole_text()).alias("norm")).withColumn("key", key_of(F.col("norm")))


def digests(docs: DataFrame, key_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, key, text_sha256) of every document, on shared files: what the directory and the look-up need."""
    return stored(_keyed(docs, key_of).select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")), "digests")


def directory(keys: DataFrame, capacity: int = CAPACITY, depth_limit: int = DEPTH_LIMIT) -> DataFrame:
    """(slot, depth, bucket) for every slot of the fully doubled directory: 2 ** ``depth_limit`` rows, whatever the input.

    A prefix of the slots whose keys exceed ``capacity`` is split in two; the buckets are the halves that fit, and the
    whole where nothing was split. All slots of a bucket point to its first slot. Overfull prefixes are counted with
    partial sums, so that no task meets all slots.
    """
    slots = keys.groupBy(_slot(depth_limit)).agg(F.count(F.lit(1)).alias("keys"))
    prefixes = slots.select("slot", "keys", F.explode(F.sequence(F.lit(0), F.lit(depth_limit - 1))).alias("depth"))
    overfull = (
        prefixes.groupBy("depth", F.expr(f"shiftright(slot, {depth_limit} - depth)").alias("prefix"))
        .agg(F.sum("keys").alias("held"))
        .where(F.col("held") > capacity)
        .select("depth", "prefix")
    )
    whole = keys.sparkSession.range(1).select(F.lit(0).alias("depth"), F.col("id").alias("prefix"))
    halves = overfull.select(
        (F.col("depth") + 1).alias("depth"),
        F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"),
    )
    buckets = whole.union(halves).join(overfull, ["depth", "prefix"], "left_anti")
    return _slots(buckets.select("depth", F.expr(f"shiftleft(prefix, {depth_limit} - depth)").alias("bucket")), depth_limit)


def _slots(buckets: DataFrame, depth_limit: int) -> DataFrame:
    last = F.expr(f"bucket + shiftleft(1L, {depth_limit} - depth) - 1")
    return buckets.select(F.explode(F.sequence("bucket", last)).alias("slot"), "depth", "bucket")


def build_index(
    docs: DataFrame,
    capacity: int = CAPACITY,
    depth_limit: int = DEPTH_LIMIT,
    key_of: Callable[[Column], Column] = F.xxhash64,
    asked: DataFrame | None = None,
) -> DataFrame:
    """The index on shared files: (bucket, depth, key, chain), dealt to owner tasks by ranges of buckets and keys.

    A chain holds the different texts under a key, each with the row that stays and its number of rows. Rows of a
    bucket are combined before the shuffle, so a text that a third of all rows share moves once per task. ``asked`` are
    the documents' ``digests`` where they are at hand.
    """
    keys = (digests(docs, key_of) if asked is None else asked).select("key").distinct()
    slots = stored(directory(keys, capacity, depth_limit), "directory")
    # 2 ** depth_limit rows of three integers
    dealt = _keyed(docs, key_of).withColumn("slot", _slot(depth_limit)).join(F.broadcast(slots), "slot")
    links = (
        dealt.groupBy("bucket", "depth", "key", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("bucket", "depth", "key", F.struct(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size").alias("link"))
    )
    owned = stored(links, "links").repartitionByRange("bucket", "key")
    chained = owned.groupBy("bucket", "depth", "key").agg(F.sort_array(F.collect_list("link")).alias("chain"))
    return stored(chained.sortWithinPartitions("bucket", "key"), "hash-index")


def look_up(asked: DataFrame, index: DataFrame, depth_limit: int = DEPTH_LIMIT) -> DataFrame:
    """The link of each of the ``digests``: its slot gives the bucket, the bucket's files the chain of its key."""
    slots = _slots(index.select("depth", "bucket").distinct(), depth_limit)
    placed = asked.withColumn("slot", _slot(depth_limit)).join(F.broadcast(slots), "slot").drop("slot", "depth")
    link = F.filter("chain", lambda x: x["text_sha256"] == F.col("text_sha256"))[0]
    found = placed.join(index.drop("depth"), ["bucket", "key"]).withColumn("link", link)
    return found.select(
        "doc_id",
        F.col("link.keep_id").alias("keep_id"),
        F.col("link.group_size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("link.keep_id")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, depth_limit: int = DEPTH_LIMIT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    A null text is empty. Texts are equal if they are the same after lower-casing A-Z. The largest doc_id of a group
    stays; rows that repeat that doc_id within the group are all marked as kept; a null doc_id stays only in a group
    of null ids. An empty table gives an empty result, other columns are not read.
    """
    asked = digests(docs)
    return look_up(asked, build_index(docs, capacity, depth_limit, asked=asked), depth_limit)
