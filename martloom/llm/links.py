"""Links between texts: digests, comparisons of a leader with many members, and classes of linked texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import chunks, stored, whole_text

MEMBERS_PER_TASK_GROUP = 500
BITMAP_BITS = 1 << 25  # 4 MB


def digest() -> Column:
    """16 bytes that name a text; a null text is empty."""
    return F.unhex(F.md5(whole_text()))


def perhaps_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """All rows whose digest is wanted and few others, found by a bitmap of a fixed size that goes to all tasks."""
    cell = F.xxhash64("digest").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1
    spots = wanted.select("digest").distinct().select(F.bitmap_bucket_number(cell).alias("page"), F.bitmap_bit_position(cell).alias("spot"))
    pages = spots.repartition("page").groupBy("page").agg(F.bitmap_construct_agg("spot").alias("bits"))
    at = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.join(F.broadcast(pages), F.bitmap_bucket_number(cell) == F.col("page"))
    return met.where(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0).select(*rows.columns)


def distinct_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(digest, text) once for each wanted digest; other texts are left out and copies combined before the shuffle."""
    texts = perhaps_wanted(docs.select(digest().alias("digest"), whole_text().alias("text")), wanted)
    # An inner join, as Spark would move a semi join below the one with the bitmap.
    return texts.join(wanted.select("digest").distinct(), "digest").groupBy("digest").agg(F.first("text").alias("text"))


def compare(pairs: DataFrame, texts: DataFrame, measure: Callable, result: str, slices: int = 1) -> DataFrame:
    """What ``measure`` finds for each (a, b, extra): rows of the DDL ``result``.

    A leader's text is sent once to each group of at most some hundred members, not once per pair; a leader of many
    members has many groups. ``measure()`` gives a function of (leader text, member text, extra) that yields tuples;
    the leader's text is the same object for all its members, so what is derived from it can be kept. With several
    ``slices`` the groups are sent one part after the other and each part's rows are stored.
    """
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    groups = F.ceil(F.col("n") / MEMBERS_PER_TASK_GROUP).cast("int")
    tails = (
        pairs.join(counts, "a")
        .withColumn("salt", F.pmod(F.xxhash64("b"), groups).cast("int"))
        .join(texts.withColumnRenamed("digest", "b"), "b")
        .select("a", "salt", F.lit(1).alias("kind"), "b", "text", "extra")
    )
    heads = (
        counts.withColumn("salt", F.explode(F.sequence(F.lit(0), groups - 1)))
        .join(texts.withColumnRenamed("digest", "a"), "a")
        .select("a", "salt", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("b"), "text", F.lit(None).cast(pairs.schema["extra"].dataType).alias("extra"))
    )
    sent = heads.unionByName(tails)
    names = [c.split()[0] for c in result.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}[c.split()[1]] for c in result.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, leader = measure(), None
        for batch in chunks(batches):
            a, b, out = [], [], []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[2] == 0:
                    leader = row[4]
                    continue
                for got in own(leader, row[4], row[5]):
                    a.append(row[0])
                    b.append(row[3])
                    out.append(got)
            found = zip(*out, strict=True) if out else ([] for _ in kinds)
            columns = [pa.array(a, pa.binary()), pa.array(b, pa.binary()), *(pa.array(c, t) for c, t in zip(found, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", *names])

    def found(part: DataFrame) -> DataFrame:
        ordered = part.repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
        return ordered.mapInArrow(run, f"a binary, b binary, {result}")

    if slices == 1:
        return found(sent)
    parts = [stored(found(sent.where(F.pmod(F.xxhash64("a", "salt"), F.lit(slices)) == i)), "compared") for i in range(slices)]
    return reduce(DataFrame.unionByName, parts)


def classes(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(digest, label): the least digest of each connected class of links (a, b).

    Each round takes the least label among the neighbours, then the label of that label, so that chains shrink by
    halves. Every round is written to the shared folder; the driver sees only how many labels changed.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("digest"), F.least("a", "m").alias("label")), "labels")
    for _ in range(most_rounds):
        around = both.join(labels.withColumnsRenamed({"digest": "b"}), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(around.withColumnRenamed("a", "digest"), "digest").select("digest", "label", F.least("label", "near").alias("next"))
        above = hooked.select(F.col("digest").alias("next"), F.col("next").alias("after"))
        jumped = hooked.join(above, "next", "left").select("digest", "label", F.least("next", F.coalesce("after", "next")).alias("new"))
        jumped = stored(jumped, "labels")
        changed = jumped.where("new <> label").limit(1).count()
        labels = jumped.select("digest", F.col("new").alias("label"))
        if not changed:
            return labels
    raise RuntimeError("classes did not settle")
