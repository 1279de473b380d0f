"""Near duplicates by improved consistent weighted sampling over TF-IDF word shingles.

A shingle's weight is its count in the text times the mean inverse document frequency of its words, which are counted
over all documents in a fixed number of hashed cells. Samples (shingle, level) of two texts agree with the probability
of their weighted Jaccard similarity. Bands of samples give buckets; in a bucket every text is compared with one
leader. Texts of a bucket that are still in different classes meet block by block, and pairs are compared unless their
weights by hashed cell or their samples rule a link out.
Only the exact weighted Jaccard similarity makes a link; linked texts form classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import chunks, mix, shingle_hashes, stored, whole_text, word_table
from martloom.llm.links import classes, compare, digest, distinct_texts

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 12
ROWS = 5
CELLS = 1 << 18
PROFILE = 256  # cells of a text's profile, a power of two
BLOCK = 256  # texts of a bucket that are compared with as many others at a time
CLOSE_SAMPLES = 33  # of BANDS * ROWS; at similarity 0.8 fewer agree three times in a million pairs


class Weigher:
    """Shingles of a text with their weights."""

    def __init__(self, idf: np.ndarray):
        self.idf = idf

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.of_words(word_table([text])[0])

    def of_words(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = min(SHINGLE, len(ids))
        if not width:
            return np.zeros(0, np.uint64), np.zeros(0, np.float32)
        sums = np.concatenate([[0.0], np.cumsum(self.idf[ids & np.uint64(CELLS - 1)], dtype=np.float64)])
        shingles, first, times = np.unique(shingle_hashes(ids, width), return_index=True, return_counts=True)
        return shingles, (times * (sums[first + width] - sums[first]) / width).astype(np.float32)


class Sampler:
    """Consistent weighted samples: for each sample the shingle with the least ln a, and its level t.

    The variates of a shingle and a sample are looked up in fixed tables by bits of their hash: r and c are gamma(2, 1),
    b is uniform.
    """

    def __init__(self, samples: int = BANDS * ROWS):
        dice = np.random.default_rng(23)
        self.r = dice.gamma(2, 1, 1 << 12).astype(np.float32) + np.float32(1e-6)
        self.ln_c = np.log(dice.gamma(2, 1, 1 << 12) + 1e-9).astype(np.float32)
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64), 99) | np.uint64(1)

    def __call__(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        best = np.full(len(self.seeds), np.inf, np.float32)
        chosen = np.zeros(len(self.seeds), np.uint64)
        level = np.zeros(len(self.seeds), np.int32)
        rows, seeds, odd = np.arange(len(self.seeds)), self.seeds[:, None], np.uint64(0x9E3779B97F4A7C15)
        for start in range(0, len(shingles), 512):  # blocks that stay in the processor's cache
            k, ln_w = shingles[start : start + 512], np.log(weights[start : start + 512])
            with np.errstate(over="ignore"):
                x = (k * odd) ^ seeds
                x *= odd
                x ^= x >> np.uint64(29)
                x *= odd
            high = (x >> np.uint64(32)).astype(np.uint32)
            r = self.r.take(high >> np.uint32(20))
            ln_a = self.ln_c.take((high >> np.uint32(8)) & np.uint32(0xFFF))
            b = (x.astype(np.uint32) >> np.uint32(8)).astype(np.float32)
            b *= np.float32(2.0**-24)
            t = ln_w / r
            t += b
            np.floor(t, out=t)
            b -= t
            b -= np.float32(1)
            b *= r
            ln_a += b  # ln c - r (t - b + 1)
            at = ln_a.argmin(axis=1)
            least = ln_a[rows, at]
            better = least < best
            best[better], chosen[better], level[better] = least[better], k[at[better]], t[rows, at][better]
        with np.errstate(over="ignore"):
            return mix(chosen ^ (level.astype(np.int64).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser over the sum of the greater weights; two texts without words are equal."""
    both = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64))
    if not both:
        return 1.0
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    least = float(np.minimum(a[1][at[same]], b[1][same]).sum(dtype=np.float64))
    return least / (both - least)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """1 + ln((1 + documents) / (1 + documents with a word of the cell)), for each hashed cell of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS + 1, np.int64)
        for batch in chunks(batches):
            ids, bounds = word_table(batch.column(0).to_pylist())
            cells = (ids & np.uint64(CELLS - 1)).astype(np.int64)
            pairs = np.unique(np.repeat(np.arange(batch.num_rows), np.diff(bounds)) * CELLS + cells)
            counts[:CELLS] += np.bincount(pairs & (CELLS - 1), minlength=CELLS)
            counts[CELLS] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()])], names=["counts"])

    parts = docs.select(whole_text().alias("text")).mapInArrow(run, "counts binary").rdd
    arrays = parts.map(lambda r: np.frombuffer(bytes(r[0]), np.int64))
    counts = arrays.treeAggregate(np.zeros(CELLS + 1, np.int64), np.add, np.add, depth=3)  # one array of a fixed size
    return (1 + np.log((1 + counts[CELLS]) / (1 + counts[:CELLS]))).astype(np.float32)


def signatures(docs: DataFrame, idf) -> DataFrame:
    """(digest, weight, bands, samples) of each distinct text with words; ``samples`` keep one byte of each sample, eight
    in a number, the last number filled with zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh, sample = Weigher(idf.value), Sampler()
        for batch in chunks(batches):
            keys, weights, bands, small = [], [], [], []
            ids, bounds = word_table(batch.column(1).to_pylist())
            for key, low, high in zip(batch.column(0).to_pylist(), bounds[:-1], bounds[1:], strict=True):
                shingles, w = weigh.of_words(ids[low:high])
                if not len(shingles):
                    continue
                s = sample(shingles, w)
                h = np.full(BANDS, 1, np.uint64)
                for i in range(ROWS):
                    h = mix(h ^ s.reshape(BANDS, ROWS)[:, i], i)
                keys.append(key)
                weights.append(float(w.sum(dtype=np.float64)))
                bands.append((h ^ mix(np.arange(BANDS, dtype=np.uint64), 7)).view(np.int64))
                small.append(np.pad(s.astype(np.uint8), (0, -len(s) % 8)).view(np.int64))
            columns = [pa.array(keys, pa.binary()), pa.array(weights, pa.float64()), pa.array(bands, pa.list_(pa.int64())), pa.array(small, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "weight", "bands", "samples"])

    schema = "digest binary, weight double, bands array<long>, samples array<long>"
    made = docs.select(digest().alias("digest"), whole_text().alias("text")).mapInArrow(run, schema)
    return made.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("weight", "bands", "samples")))


def shingle_rows(texts: DataFrame, idf) -> DataFrame:
    """(shingle, digest, share) of every shingle of every text: its part of the text's weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = Weigher(idf.value)
        for batch in chunks(batches, 16):
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            found = [weigh(t) for t in texts]
            rows = np.repeat(np.arange(len(texts)), [len(s) for s, _ in found])
            shingles = np.concatenate([s for s, _ in found])
            shares = np.concatenate([w / max(w.sum(dtype=np.float64), 1e-30) for _, w in found])
            columns = [pa.array(shingles.view(np.int64)), keys.take(pa.array(rows)), pa.array(shares.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(columns, names=["shingle", "digest", "share"])

    return texts.select("digest", "text").mapInArrow(run, "shingle long, digest binary, share double")


def rare_shingles(texts: DataFrame, idf, similarity: float) -> DataFrame:
    """(shingle, digest, short, common): the rare shingles of each text; two similar texts of these have one in common.

    All texts order their shingles alike, by how many texts have them. From the first shingle that two similar texts
    share, both must have enough weight left for all they share, so it is not far down either list. ``short`` marks the
    shingles that the lighter text of a pair needs; the heavier one needs all that are given. Shingles of one text are
    left out before the lists are made; ``common`` is the part of the text's weight that others have, too, which bounds
    its similarity to any of them: a text below has no row.
    """
    each = shingle_rows(texts, idf)
    held = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    last_first = Window.partitionBy("digest").orderBy(F.desc("n"), F.desc("shingle"))  # a window holds one text
    left = F.sum("share").over(last_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    common = F.sum("share").over(Window.partitionBy("digest"))
    ordered = each.join(held, "shingle").select("shingle", "digest", left.alias("left"), common.alias("common"))
    short = (F.col("left") >= 2 * similarity / (1 + similarity) * 0.9999).alias("short")
    return ordered.where(F.col("left") >= similarity * 0.9999).select("shingle", "digest", short, "common")


def _near(x: Column, y: Column, similarity: float) -> Column:
    """Whether two weights are close enough for texts of that similarity."""
    return F.least(x, y) >= similarity * 0.9999 * F.greatest(x, y)


def agreeing(x: Column, y: Column) -> Column:
    """How many of the sample bytes that ``signatures`` packs into numbers are equal."""
    numbers = -(-BANDS * ROWS // 8)
    other = F.lit(0)
    for i in range(numbers):
        bits = x[i].bitwiseXOR(y[i])
        for shift in (4, 2, 1):  # the last bit of a byte becomes 1 where any of its bits is
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        other = other + F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))
    return F.lit(BANDS * ROWS) - other


def likely(x: Column, y: Column, similarity: float) -> Column:
    """Whether two texts can be so similar: by what they share with any other, their samples, and a common bucket.

    Each side has weight, common, samples and buckets.
    """
    needed = similarity * 0.9999 / (1 + similarity) * (x["weight"] + y["weight"])
    enough = (x["common"] >= needed) & (y["common"] >= needed)
    return enough & (agreeing(x["samples"], y["samples"]) >= CLOSE_SAMPLES) & F.arrays_overlap(x["buckets"], y["buckets"])


def sharing_pairs(entries: DataFrame, similarity: float, only: Callable[[Column, Column, float], Column] | None = None) -> DataFrame:
    """(x, y): digests of different labels that have a rare shingle in common, the lighter text first.

    ``entries`` has shingle, digest, short, label and weight. Labels meet on a shingle first, so that the texts of one
    class never meet each other, however many have the shingle. With ``only`` a pair must also meet that condition on the
    two texts' column ``facts``, in the join itself: pairs that cannot be links are not written, sorted or counted.
    """
    held = entries.groupBy("shingle", "label").agg(F.max("short").alias("short"))
    shared = held.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    held = held.join(shared.select("shingle"), "shingle")
    other = held.select("shingle", F.col("label").alias("label_y"))
    met = held.where("short").join(other, "shingle").where("label <> label_y").select("shingle", "label", "label_y")
    facts = [] if only is None else ["facts"]
    x = entries.where("short").select("shingle", "label", F.col("digest").alias("x"), F.col("weight").alias("weight_x"), *[F.col(c).alias("of_x") for c in facts])
    y = entries.select("shingle", F.col("label").alias("label_y"), F.col("digest").alias("y"), F.col("weight").alias("weight_y"), *[F.col(c).alias("of_y") for c in facts])
    order = F.struct(F.col("weight_x").alias("w"), F.col("x").alias("d")) < F.struct(F.col("weight_y").alias("w"), F.col("y").alias("d"))
    close = order & _near(F.col("weight_x"), F.col("weight_y"), similarity)
    if only is not None:
        close = close & only(F.col("of_x"), F.col("of_y"), similarity)
    return met.join(x, ["shingle", "label"]).join(y, ["shingle", "label_y"]).where(close).select("x", "y").distinct()


def profiles(texts: DataFrame, idf) -> DataFrame:
    """(digest, profile): the weight of each text's shingles by hashed cell, rounded up to half precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = Weigher(idf.value)
        for batch in chunks(batches):
            ids, bounds = word_table(batch.column(1).to_pylist())
            sums = np.zeros((batch.num_rows, PROFILE))
            for row, low, high in zip(sums, bounds[:-1], bounds[1:], strict=True):
                shingles, w = weigh.of_words(ids[low:high])
                row[:] = np.bincount((shingles & np.uint64(PROFILE - 1)).astype(np.int64), w, PROFILE)
            with np.errstate(over="ignore"):  # an infinite cell bounds nothing, which is safe
                half = (sums * (1 + 2**-10)).astype(np.float16)
            made = [batch.column(0), pa.array([r.tobytes() for r in half], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=["digest", "profile"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, profile binary")


def bucket_pairs(entries: DataFrame, similarity: float) -> DataFrame:
    """(a, b): digests of one bucket and different labels that may reach ``similarity``, the lesser first.

    ``entries`` has bucket, digest, label, weight, samples and profile. A bucket is cut into blocks, and every two blocks
    meet as one group of bounded size, so a large bucket is spread over tasks and only pairs that pass are written. What
    two texts share weighs at most the sum over the cells of the lesser weight: that bound rules out the most, as texts
    made from one text differ in different cells.
    """
    crowd = entries.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    dealt = entries.join(crowd, "bucket").withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = dealt.select("bucket", low, high, "block", "digest", "label", "weight", "samples", "profile")
    groups = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    share = similarity * 0.9999 / (1 + similarity)

    def pairs(batch: pa.RecordBatch, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        block, weight = batch.column(3).to_numpy(), batch.column(6).to_numpy()
        alone = batch.column(1).to_numpy() == batch.column(2).to_numpy()
        label = batch.column(5).dictionary_encode().indices.to_numpy()
        samples = batch.column(7).flatten().to_numpy().reshape(batch.num_rows, -1).view(np.uint8)[:, : BANDS * ROWS]
        profile = np.frombuffer(b"".join(batch.column(8).to_pylist()), np.float16).reshape(batch.num_rows, -1).astype(np.float32)
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            for i in range(start, end - 1):
                w = weight[i + 1 : end]
                fit = (label[i + 1 : end] != label[i]) & (np.minimum(w, weight[i]) >= similarity * 0.9999 * np.maximum(w, weight[i]))
                at = i + 1 + np.flatnonzero(fit if alone[i] else fit & (block[i + 1 : end] != block[i]))
                at = at[(samples[at] == samples[i]).sum(axis=1) >= CLOSE_SAMPLES]
                at = at[np.minimum(profile[at], profile[i]).sum(axis=1) >= share * (weight[at] + weight[i])]
                if len(at):
                    yield i, at

    def found(batch: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
        both = list(pairs(batch, bounds))
        first = np.repeat([i for i, _ in both], [len(at) for _, at in both]).astype(np.int64)
        second = np.concatenate([np.zeros(0, np.int64), *(at for _, at in both)])
        digests = batch.column(4)
        return pa.RecordBatch.from_arrays([digests.take(pa.array(first)), digests.take(pa.array(second))], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            keys = np.column_stack([rest.column(i).to_numpy() for i in range(3)])
            starts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1]
            if len(starts) > 1:  # the last group may go on in the next batch
                yield found(rest.slice(0, starts[-1]), starts)
                rest = rest.slice(starts[-1])
        if rest is not None:
            yield found(rest, np.array([0, rest.num_rows]))

    met = groups.mapInArrow(run, "x binary, y binary")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def links(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity): pairs of digests whose weighted Jaccard similarity reaches ``similarity``, enough of them
    to connect every class: pairs of a bucket that others do not connect already are compared where they can be similar.
    """
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))  # CELLS numbers
    signed = stored(signatures(docs, idf), "signatures")
    members = signed.select("digest", "weight", F.explode("bands").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stored(members.join(crowded, "bucket"), "buckets")
    # The text that meets most others leads: the one that copies derive from, if there is one.
    popular = met.groupBy("digest").agg(F.sum("n").alias("meets"))
    ranked = met.join(popular, "digest").select("bucket", "digest", "weight", F.struct("meets", "digest", "weight").alias("rank"))
    ranked = stored(ranked, "ranked-buckets")
    leads = ranked.groupBy("bucket").agg(F.max("rank").alias("lead"))
    shared = ranked.join(leads, "bucket").select("bucket", "digest", "weight", "lead")
    texts = stored(distinct_texts(docs, ranked), "candidate-texts", codec="zstd")
    close = _near(F.col("weight"), F.col("lead.weight"), similarity)
    stars = shared.where((F.col("digest") != F.col("lead.digest")) & close)
    pairs = stars.select(F.col("lead.digest").alias("a"), F.col("digest").alias("b")).distinct().withColumn("extra", F.lit(0))

    def measure():
        weigh, kept = Weigher(idf.value), [None, None]

        def one(a: str, b: str, _) -> Iterator[tuple[float]]:
            if kept[0] is not a:
                kept[:] = [a, weigh(a)]
            got = weighted_jaccard(kept[1], weigh(b))
            if got >= similarity:
                yield (got,)

        return one

    first = stored(compare(pairs, texts, measure, "similarity double"), "star-links")
    settled = classes(first)
    label = F.coalesce("label", "digest").alias("label")
    placed = shared.select("bucket", "digest").join(settled, "digest", "left").select("bucket", "digest", label)
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    # Texts of one bucket in different classes are compared unless their weights or samples rule it out, leaders not again.
    rows = placed.join(mixed.select("bucket"), "bucket").join(signed.select("digest", "weight", "samples"), "digest")
    entries = stored(rows.join(profiles(texts, idf), "digest"), "open-texts")
    across = bucket_pairs(entries, similarity)
    met_leaders = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = across.join(met_leaders, ["a", "b"], "left_anti")
    second = stored(compare(rest.withColumn("extra", F.lit(0)), texts, measure, "similarity double"), "cross-links")
    return first.unionByName(second)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept.

    A class holds equal texts and all that chains of links reach; ``class_id`` is its least doc_id, and that row is
    ``kept``. Texts are compared in lower case by words; shorter texts than five words have one shingle, their words;
    empty, blank and null texts are equal to their own kind only. Rows that repeat the least doc_id are all kept; null
    ids are never kept beside others, and a class of null ids has no class_id and is kept. An empty table gives no rows.
    """
    rows = docs.select("doc_id", digest().alias("digest"))
    labels = classes(links(docs, similarity))
    placed = stored(rows.join(labels, "digest", "left").select("doc_id", F.coalesce("label", "digest").alias("label")), "placed")
    sizes = placed.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    return placed.join(sizes, "label").select("doc_id", "class_id", "class_size", kept)


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that stay, with all their columns."""
    gone = near_duplicates(docs, similarity).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
