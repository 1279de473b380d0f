"""Log-bilinear language model, trained in numpy by noise-contrastive estimation.

Words fall into classes: each of the most frequent words is a class of its own, the others are classed by a hash of
their last letters. The network predicts the class of a token from the two classes before it; within a class a word
has its smoothed share of the corpus counts. Both factors sum to one, so the product is a normalised probability:
the network's normaliser is computed for all pairs of classes by batched matrix products.

The network learns from every training token: tasks count how often each class follows two others, the counts are dealt
to shards of equal size and like mass, and in each round all shards are trained side by side from the same weights,
whose mean by mass starts the next round. The driver sees one set of weights a round. The number of classes of single
words grows with the tokens, and the counts and shards with the corpus, up to one count for each triple of classes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import chunks, fold_of, stored, whole_text

OWN_RATE, OWN_POWER, OWN_LIMIT = 24, 1 / 6, 1919  # words with a class of their own: rate * tokens ** power
ENDING_CLASSES = 128
WIDTH = 32
COMMON_WORDS = 300_000
CLASS_BITS = 12
ROUNDS = 2
SHARD_ROWS = 400_000
HEAVY = 4  # a count of more than this many means is trained in several parts
BLOCKS = 16
FOLDS, HELD_OUT = 10, 0
ALPHA = 0.1
END_TOKEN = b" "  # no word holds a blank
FLUSH_WORDS = 1_000_000
FLUSH_TOKENS = 2_000_000


def tokens_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case, then the end."""
    return [*text.encode().lower().split(), END_TOKEN]


def ending_class(word: bytes) -> int:
    """Class of a word that has none of its own: by its last two letters; commas and stops at the end count apart."""
    body = word.rstrip(b".,;:!?")
    return zlib.crc32(body.decode(errors="replace")[-2:].encode() + word[len(body) : len(body) + 1]) % ENDING_CLASSES


def own_classes(tokens: int) -> int:
    """How many of the most frequent words have a class of their own."""
    return min(OWN_LIMIT, 1 + round(OWN_RATE * tokens**OWN_POWER))


class Words:
    """Packed class and place of words; place 0 stands for any word that is not among the common ones."""

    def __init__(self, common: list[tuple[bytes, int]], most_own: int):
        own = sorted(common, key=lambda x: (-x[1], x[0]))[:most_own]
        self.own = {w: ENDING_CLASSES + i for i, (w, _) in enumerate(own)}
        self.classes = ENDING_CLASSES + len(own)
        self.packed = {w: (i + 1) << 16 | self.class_of(w) for i, (w, _) in enumerate(common)}
        self.counts = np.array([0, *(c for _, c in common)], np.int64)
        self.other: dict[bytes, int] = {}

    def class_of(self, word: bytes) -> int:
        own = self.own.get(word)
        return ending_class(word) if own is None else own

    def __call__(self, words: list[bytes]) -> np.ndarray:
        packed, other = self.packed, self.other
        if len(other) > COMMON_WORDS:
            other.clear()
        try:
            found = [packed[w] if w in packed else other[w] for w in words]
        except KeyError:
            other.update((w, self.class_of(w)) for w in words if w not in packed and w not in other)
            found = [packed[w] if w in packed else other[w] for w in words]
        return np.array(found, np.int64)


def sum_by(kinds: np.ndarray, rows: np.ndarray, classes: int) -> np.ndarray:
    """The sum of the rows of each class."""
    width = rows.shape[1]
    out = np.zeros(classes * width, np.float32)
    np.add.at(out, (kinds[:, None].astype(np.int64) * width + np.arange(width)).ravel(), rows.ravel())
    return out.reshape(classes, width)


class Network:
    """Class vectors as context (for each of two places) and as target, with target biases."""

    def __init__(self, classes: int, seed: int = 5):
        dice = np.random.default_rng(seed)
        self.near, self.far, self.target = (dice.normal(0, 0.1, (classes, WIDTH)).astype(np.float32) for _ in range(3))
        self.bias = np.zeros(classes, np.float32)

    def flat(self) -> np.ndarray:
        """All weights in one row."""
        return np.concatenate([p.ravel() for p in (self.near, self.far, self.target, self.bias)])

    def load(self, flat: np.ndarray) -> Network:
        """The weights that ``flat`` gave."""
        for p in (self.near, self.far, self.target, self.bias):
            p.ravel()[:], flat = flat[: p.size], flat[p.size :]
        return self

    def train(
        self,
        far: np.ndarray,
        near: np.ndarray,
        target: np.ndarray,
        weight: np.ndarray | None = None,
        share: np.ndarray | None = None,
        epochs: int = 4,
        batch: int = 768,
        noise: int = 96,
        seed: tuple[int, ...] = (11,),
        rates: tuple[float, float] = (0.03, 0.0006),
    ) -> Network:
        """Noise-contrastive estimation: a batch shares ``noise`` classes drawn by their frequency.

        A row counts ``weight`` times. With ``share``, the frequency of the classes, the network's biases stay as they
        are; else both are taken from the targets. The rate falls from the first of ``rates`` to the second.
        """
        dice, classes = np.random.default_rng(seed), len(self.bias)
        weight = np.ones(len(target), np.float32) if weight is None else weight.astype(np.float32)
        if share is None:
            share = (np.bincount(target, minlength=classes) + 1.0) / (len(target) + classes)
            self.bias[:] = np.log(share)
        log_noise = np.log(noise * share).astype(np.float32)
        held = [self.near, self.far, self.target, self.bias[:, None]]
        power = [np.zeros(p.shape, np.float32) for p in held]
        steps, done = epochs * max(1, -(-len(target) // batch)), 0
        for _ in range(epochs):
            order = dice.permutation(len(target))
            for start in range(0, len(order), batch):
                rows = order[start : start + batch]
                a, b, t, w = far[rows], near[rows], target[rows], weight[rows]
                w = w / w.sum()
                drawn = dice.choice(classes, noise, p=share)
                context = self.near[b] + self.far[a]
                own = np.einsum("ij,ij->i", context, self.target[t]) + self.bias[t] - log_noise[t]
                false = context @ self.target[drawn].T + (self.bias[drawn] - log_noise[drawn])
                g_own = (w * (1 / (1 + np.exp(-np.clip(own, -30, 30))) - 1)).astype(np.float32)
                g_false = w[:, None] / (1 + np.exp(-np.clip(false, -30, 30)))
                g_context = g_own[:, None] * self.target[t] + g_false @ self.target[drawn]
                g_target = np.hstack([g_own[:, None] * context, g_own[:, None]])
                g_target = sum_by(t, g_target, classes)
                np.add.at(g_target, drawn, np.hstack([g_false.T @ context, g_false.sum(axis=0)[:, None]]))
                grads = [sum_by(b, g_context, classes), sum_by(a, g_context, classes), g_target[:, :-1], g_target[:, -1:]]
                rate = rates[0] + (rates[1] - rates[0]) * done / steps
                done += 1
                for p, g, s in zip(held, grads, power, strict=True):  # scaled by the recent size of each gradient
                    s *= 0.98
                    s += 0.02 * g * g
                    p -= rate * g / (np.sqrt(s / (1 - 0.98**done)) + 1e-5)
        return self

    def normalisers(self, batch: int = 4096) -> np.ndarray:
        """log of the sum over all classes, for each pair (far, near)."""
        classes = len(self.bias)
        out = np.empty((classes, classes), np.float32)
        for a in range(classes):
            z = (self.near + self.far[a]) @ self.target.T + self.bias
            top = z.max(axis=1)
            out[a] = top + np.log(np.exp(z - top[:, None]).sum(axis=1))
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all tokens; tasks combine before they emit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], names=["word", "n"])
            totals.clear()
            return got

        for batch in chunks(batches):
            for text in batch.column(0).to_pylist():
                totals.update(tokens_of(text))
            if len(totals) > FLUSH_WORDS:
                yield out()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_words(counts: DataFrame, most: int = COMMON_WORDS) -> list[tuple[bytes, int]]:
    """At most ``most`` words: all whose count reaches the least bound that keeps them that few."""
    capped = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count(F.lit(1)).alias("words"))
    total, bound = 0, 100_001
    for r in capped.orderBy(F.desc("n")).collect():  # at most 100,000 rows
        if total + r.words > most:
            break
        total, bound = total + r.words, r.n
    rows = counts.where(F.col("n") >= bound).collect()
    return sorted(((bytes(r.word), r.n) for r in rows), key=lambda x: (-x[1], x[0]))


def class_triples(training: DataFrame, words: Broadcast) -> DataFrame:
    """(triple, n): how often a class follows two others, over all training texts; tasks combine before they emit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, tokens = words.value, [], 0
        end = own.class_of(END_TOKEN)

        def out() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["triple", "n"])

        for batch in chunks(batches):
            for text in batch.column(0).to_pylist():
                k = np.r_[end, end, own(tokens_of(text)) & 0xFFFF]
                held.append(k[:-2] << 2 * CLASS_BITS | k[1:-1] << CLASS_BITS | k[2:])
                tokens += len(k) - 2
                if tokens > FLUSH_TOKENS:
                    yield out()
                    tokens = 0
        if held:
            yield out()

    return training.select("text").mapInArrow(run, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))


def deal_shards(triples: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: its triples, and the part of each one's count that it holds.

    A heavy count is dealt in equal parts to as many shards as it is heavy, so no shard is ruled by one triple.
    """
    held = triples.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows, tokens = int(held[0]), int(held[1])
    shards = max(1, -(-rows // shard_rows))
    parts = F.least(F.ceil(F.col("n") / (HEAVY * max(tokens, 1) / max(rows, 1))), F.lit(shards)).cast("int")
    dealt = triples.select("triple", "n", parts.alias("parts"), F.explode(F.sequence(F.lit(1), parts)).alias("part"))
    shard = ((F.pmod(F.xxhash64("triple"), F.lit(shards)) + F.col("part")) % shards).cast("int")
    weight = (F.col("n") / F.col("parts")).cast("float")

    def pack(table: pa.Table) -> pa.Table:
        of, triple, weights = (table.column(i).to_numpy() for i in range(3))
        order = np.argsort(triple, kind="stable")
        columns = [[int(of[0])], [triple[order].astype("<i8").tobytes()], [weights[order].astype("<f4").tobytes()]]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "triples", "weights"])

    grouped = dealt.select(shard.alias("shard"), "triple", weight.alias("weight")).repartition(shards, "shard")
    return grouped.groupBy("shard").applyInArrow(pack, "shard int, triples binary, weights binary")


def train_on_shards(network: Network, shards: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> Network:
    """The network after ``rounds`` in which every shard starts from the same weights and their means by mass are taken."""
    spark = shards.sparkSession
    network.bias[:] = np.log(share)
    top, low = 0.03, 0.0006
    for at in range(rounds):
        shared = spark.sparkContext.broadcast((network.flat(), share))
        rates = tuple(top + (low - top) * i / rounds for i in (at, at + 1))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rates=rates, at=at) -> Iterator[pa.RecordBatch]:
            flat, by_class = shared.value
            mask = (1 << CLASS_BITS) - 1
            for shard, triples, weights in ((x.as_py() for x in row) for batch in batches for row in zip(*batch.columns, strict=True)):
                triple, weight = np.frombuffer(triples, "<i8"), np.frombuffer(weights, "<f4").astype(np.float64)
                parts = np.ceil(weight / (HEAVY * weight.mean())).astype(np.int64)
                triple, weight = np.repeat(triple, parts), np.repeat(weight / parts, parts)
                far, near, target = ((triple >> b & mask).astype(np.int16) for b in (2 * CLASS_BITS, CLASS_BITS, 0))
                own = Network(len(by_class)).load(flat)
                own.train(far, near, target, weight, by_class, epochs=1, seed=(11, at, shard), rates=rates)
                blocks = [b.astype("<f4").tobytes() for b in np.array_split(own.flat(), BLOCKS)]
                columns = [list(range(BLOCKS)), [shard] * BLOCKS, [float(weight.sum())] * BLOCKS, blocks]
                kinds = (pa.int32(), pa.int32(), pa.float64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "shard", "mass", "weights"])

        def mean(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: r["shard"])
            mass = sum(r["mass"] for r in rows)
            total = sum(np.frombuffer(r["weights"], "<f4") * (r["mass"] / mass) for r in rows)
            return pa.table({"block": pa.array([rows[0]["block"]], pa.int32()), "weights": pa.array([total.astype("<f4").tobytes()], pa.binary())})

        trained = shards.mapInArrow(run, "block int, shard int, mass double, weights binary")
        blocks = trained.groupBy("block").applyInArrow(mean, "block int, weights binary").collect()  # BLOCKS rows
        if blocks:
            network.load(np.concatenate([np.frombuffer(r.weights, "<f4") for r in sorted(blocks, key=lambda r: r.block)]))
        shared.unpersist()
    return network


def score_corpus(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Counts and the network's weights come from every training document. A null text is empty and has the end token
    alone; a null id is hashed as the text ``null``; repeated rows are scored and counted each; very long texts are
    scored whole. Without training tokens both scores are those of unseen words; an empty table gives an empty result.
    Columns other than ``doc_id`` and ``text`` are not read, whatever their names.
    """
    spark = docs.sparkSession
    held = (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    texts = docs.select("doc_id", held, whole_text().alias("text"))
    training = texts.where(~F.col("held_out"))
    counts = stored(count_words(training), "word-counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, n_words = int(sums[0]), int(sums[1])
    words = spark.sparkContext.broadcast(Words(common_words(counts), own_classes(n_all)))  # at most COMMON_WORDS words
    classes = words.value.classes

    def class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v, of = np.zeros(classes, np.int64), np.zeros(classes, np.int64), words.value.class_of
        for batch in batches:
            k = np.array([of(w) for w in batch.column(0).to_pylist()], np.int64)
            np.add.at(n, k, batch.column(1).to_numpy())
            np.add.at(v, k, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes)), pa.array(n), pa.array(v)], names=["k", "n", "v"])

    held_by = counts.mapInArrow(class_sums, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    within, share = np.zeros(classes), np.ones(classes)  # log10 of each class's denominator, and its frequency
    for r in held_by.collect():
        within[r.k] = r.n + ALPHA * (r.v + 1)
        share[r.k] += r.n
    within = np.log10(np.where(within > 0, within, ALPHA))

    end = words.value.class_of(END_TOKEN)
    triples = stored(class_triples(training, words), "class-triples")
    shards = stored(deal_shards(triples), "class-shards")
    network = train_on_shards(Network(classes), shards, share / share.sum(), rounds)
    log_z = network.normalisers()
    weights = spark.sparkContext.broadcast((network.near, network.far, network.target, network.bias, log_z, within))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = words.value
        near, far, target, bias, z, inner = weights.value
        base_log = np.log10(own.counts + ALPHA)
        row = TaskContext.get().partitionId() << 40
        for batch in chunks(batches):
            out = []
            for text in batch.column(2).to_pylist():
                tokens = tokens_of(text)
                packed = own(tokens)
                k, place = packed & 0xFFFF, packed >> 16
                before = np.r_[end, end, k[:-1]]
                a, b = before[:-1], before[1:]
                log_class = np.zeros(len(k))
                for s in range(0, len(k), 65536):
                    e = slice(s, s + 65536)
                    dot = np.einsum("ij,ij->i", near[b[e]] + far[a[e]], target[k[e]])
                    log_class[e] = dot + bias[k[e]] - z[a[e], b[e]]
                model = log_class.sum() / np.log(10) - inner[k].sum()
                common = place > 0
                rare = Counter(tokens[i] for i in np.nonzero(~common)[0])
                out.append((row, len(tokens), int(common.sum()), float(base_log[place[common]].sum()), float(model), list(rare), list(rare.values())))
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=fields)

    fields = ["doc_id", "held_out", "row", "n_tokens", "common", "log_counts", "log_model", "rare", "times"]
    ids = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {ids}, held_out boolean, row long, n_tokens long, common long, log_counts double, log_model double, rare array<binary>, times array<long>"
    scored = stored(texts.mapInArrow(score, kinds), "partial-scores")
    asked = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    found = asked.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + ALPHA)).alias("log_rare"),
    )
    logs = F.col("log_counts") + F.coalesce("log_rare", F.lit(0.0))
    base = float(np.log10(n_all + ALPHA * (n_words + 1)))
    return scored.drop("rare", "times").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("common") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * base).alias("base_score"),
        (logs + F.col("log_model")).alias("score"),
    )
