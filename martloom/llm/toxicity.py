"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the words and word beginnings of a text is trained in numpy from confirmed toxic texts and
texts taken without their labels. The risk uses the share of toxic texts: prior * R+(P) + max(0, R-(U) - prior *
R-(P)); where the second part falls below zero, the step goes the other way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import chunks, fold_of, stored, whole_text

POSITIVES = 8000
UNLABELLED = 24000
FEATURES = 1024
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
BEGINNINGS = (4, 5, 6)
CACHE_WORDS = 400_000
WORD = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, the latter with a dash."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


class Model:
    """Weights by feature, and a bias."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: float):
        self.names, self.weights, self.bias = names, weights, bias

    def ready(self) -> Model:
        self.index, self.known = {n: i for i, n in enumerate(self.names)}, {}
        return self

    def present(self, text: str) -> list[int]:
        """Numbers of the features that the text has."""
        index, known, found = self.index, self.known, set()
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words_of(text):
            got = known.get(w)
            if got is None:
                got = known[w] = tuple(index[f] for f in features_of(w) if f in index)
            if got:
                found.update(got)
        return sorted(found)

    def score(self, text: str) -> float:
        z = self.bias + float(self.weights[self.present(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train_nnpu(x: np.ndarray, positive: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.05, decay: float = 1e-4):
    """Weights and bias by gradient steps on the non-negative risk with the logistic loss."""
    p, u = x[positive].astype(np.float32), x[~positive].astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for i in range(1, rounds + 1):
        zp, zu = p @ w + b, u @ w + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up, uu = sigmoid(zp), sigmoid(zu)
        risk_p = np.r_[p.T @ (up - 1), (up - 1).sum()] / len(p) * prior
        risk_n = np.r_[u.T @ uu, uu.sum()] / len(u) - prior * np.r_[p.T @ up, up.sum()] / len(p)
        grad = risk_p + risk_n if negative >= 0 else -risk_n
        grad[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model:
    """A model from at most ``positives`` toxic and ``unlabelled`` other rows of the training folds, chosen by a hash
    of their ids; the toxic share is taken over all labelled training rows. Without toxic rows every score is near 0.
    """
    training = F.col("doc_id").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT)
    known = labels.select("doc_id", "toxic").where(training & F.col("toxic").isNotNull())
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    order = F.xxhash64("doc_id")
    toxic = known.where("toxic = 1").select("doc_id").distinct().orderBy(order, "doc_id").limit(positives)
    other = docs.select("doc_id").where(training).distinct().orderBy(order, "doc_id").limit(unlabelled)
    chosen = toxic.withColumn("positive", F.lit(True)).unionByName(other.withColumn("positive", F.lit(False)))
    sample = stored(
        docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id").select("positive", "text"),
        "toxicity-sample",
    )  # broadcast: positives + unlabelled ids at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {True: Counter(), False: Counter()}
        for batch in chunks(batches):
            for flag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[flag].update({f for w in words_of(text) for f in features_of(w)})
        seen = list(totals[True])  # a feature that no toxic text has is never chosen
        columns = [pa.array(seen, pa.string()), *(pa.array([totals[k][f] for f in seen], pa.int64()) for k in (True, False))]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "p", "u"])
        others = [f for f in totals[False] if f not in totals[True]]
        columns = [pa.array(others, pa.string()), pa.array([0] * len(others), pa.int64()), pa.array([totals[False][f] for f in others], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "p", "u"])

    sizes = {r.positive: r.n for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u or not prior:
        return Model([], np.zeros(0, np.float32), -4.0)
    p, u = F.col("p") / n_p, F.col("u") / n_u
    apart = (p - u) / F.sqrt(p / n_p + u / n_u + F.lit(1.0 / n_p) ** 2)
    counted = sample.mapInArrow(count, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    best = counted.where("p >= 3").withColumn("apart", apart).where(F.col("apart") > 2.5).orderBy(F.desc("apart"), "feature").limit(features)
    names = sorted(r.feature for r in best.select("feature").collect())
    if not names:
        return Model([], np.zeros(0, np.float32), float(np.log(prior / (1 - min(prior, 0.99)))))
    model = Model(names, np.zeros(len(names), np.float32), 0.0)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.ready()
        for batch in chunks(batches):
            rows = [own.present(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["positive", "has"])

    vectors = sample.mapInArrow(present, "positive boolean, has array<int>").toPandas()
    x = np.zeros((len(vectors), len(names)), np.bool_)
    for i, has in enumerate(vectors["has"]):
        x[i, np.asarray(has, dtype=np.int64)] = True
    model.weights, model.bias = train_nnpu(x, vectors["positive"].to_numpy(), min(float(prior), 0.95))
    return model


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.ready()
        for batch in chunks(batches):
            scores = pa.array([own.score(t) for t in batch.column(2).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=["doc_id", "held_out", "score"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    asked = docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), whole_text().alias("text"))
    scored = asked.mapInArrow(run, f"doc_id {ids}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labelled ids whose crc32 modulo 4 is not 2. A null text is empty and scored like one; a null id is
    hashed as the text ``null``; repeated rows each get a row. Without documents or toxic labels no weight is learnt
    and every score is low.
    """
    return score_texts(docs, fit(docs, labels))
