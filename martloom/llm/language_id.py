"""Language identification in two steps: the family first, then one-versus-one linear classifiers within it.

Texts are vectors of hashed byte triples (square roots of counts, unit length). All classifiers are linear support
vector machines trained in numpy; a logistic curve over the margin gives a probability.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import chunks, fold_of, whole_text

BUCKETS = 8192
PER_LANGUAGE = 800
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Families of ISO 639-1 codes; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nl", "nn", "no", "nb", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu", "se"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "sa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "ug", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def vector(text: str, out: np.ndarray) -> bool:
    """Fills ``out``; false where the text has no letter."""
    if not any(map(str.isalpha, text)):
        out[:] = 0
        return False
    raw = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
    key = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA77) + raw[2:] * np.uint32(0xC2B2AE3D)
    key = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    np.sqrt(np.bincount(key >> np.uint32(32 - 13), minlength=BUCKETS), out=out, casting="unsafe")
    out /= np.linalg.norm(out)
    return True


def train_svm(x: np.ndarray, y: np.ndarray, rounds: int = 150, decay: float = 1e-4) -> tuple[np.ndarray, float, float, float]:
    """Weights and bias by steps on the squared hinge loss, both sides weighted alike; then the slope and shift of a
    logistic curve over the margins. ``y`` is +1 or -1.
    """
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for i in range(1, rounds + 1):
        slack = np.maximum(1 - y * (x @ w + b), 0) * y * share
        grad = np.r_[decay * w - 2 * (x.T @ slack), -2 * slack.sum()].astype(np.float32)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = 0.05 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    z, slope, shift = x @ w + b, 1.0, 0.0
    for _ in range(200):
        off = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30))) - (y > 0)
        slope, shift = slope - 2.0 * float((share * off * z).sum()), shift - 2.0 * float((share * off).sum())
        slope = min(max(slope, 0.1), 50.0)
    return w, float(b), slope, shift


class Model:
    """Linear classifiers between families and between the languages of each family."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray):
        self.languages = languages
        self.family = [FAMILY_OF.get(lang, lang) for lang in languages]
        self.families = sorted(set(self.family))
        self.pairs: list[tuple[str, str]] = []
        trained = []
        of_row = np.array(self.family, dtype=object)[y] if len(y) else np.array([], dtype=object)
        named = np.array(languages, dtype=object)[y] if len(y) else np.array([], dtype=object)
        groups = [("family", self.families, of_row)]
        groups += [("language", [lang for lang, own in zip(languages, self.family, strict=True) if own == f], named) for f in self.families]
        for _, names, rows in groups:
            for a, b in itertools.combinations(names, 2):
                part = (rows == a) | (rows == b)
                self.pairs.append((a, b))
                trained.append(train_svm(x[part], np.where(rows[part] == a, 1.0, -1.0).astype(np.float32)))
        self.w = np.array([t[0] for t in trained], np.float32).reshape(len(trained), x.shape[1]).T
        self.rest = np.array([t[1:] for t in trained]).reshape(len(trained), 3)

    def choose(self, names: list[str], chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the name that wins its weakest comparison by most, and that chance."""
        won = np.ones((len(chance), len(names)))
        place = {n: i for i, n in enumerate(names)}
        for k, (a, b) in enumerate(self.pairs):
            if a in place and b in place:
                won[:, place[a]] = np.minimum(won[:, place[a]], chance[:, k])
                won[:, place[b]] = np.minimum(won[:, place[b]], 1 - chance[:, k])
        best = won.argmax(axis=1)
        return best, won[np.arange(len(won)), best]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        z = np.clip((x @ self.w + self.rest[:, 0]) * self.rest[:, 1] + self.rest[:, 2], -30, 30)
        chance = 1 / (1 + np.exp(-z))
        family, sure = self.choose(self.families, chance)
        named, score = np.empty(len(x), dtype=object), np.zeros(len(x))
        for i, f in enumerate(self.families):
            names = [lang for lang, own in zip(self.languages, self.family, strict=True) if own == f]
            best, within = self.choose(names, chance)
            own = family == i
            named[own], score[own] = np.array(names, dtype=object)[best[own]], (sure * within)[own]
        return named.tolist(), score


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from about ``per_language`` training texts of each language, chosen by a hash of their ids."""
    training = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT)
    )
    held = {r.lang: r.n for r in training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not held:
        return None
    dice = (F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 11) / float(1 << 53)).alias("dice")
    rates = docs.sparkSession.createDataFrame([(k, per_language / n) for k, n in held.items()], "lang string, rate double")
    chosen = training.join(F.broadcast(rates), "lang").where(dice < F.col("rate")).select("lang", "text")  # a row per language

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = np.zeros(BUCKETS, np.float32)
        for batch in chunks(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if vector(text, row):
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([row.astype(np.float16).tobytes()])], names=["lang", "x"])

    rows = chosen.mapInArrow(vectors, "lang string, x binary").toPandas().sort_values(["lang", "x"])
    if rows.empty:
        return None
    languages = sorted(set(rows["lang"]))
    x = np.stack([np.frombuffer(r, np.float16) for r in rows["x"]]).astype(np.float32)
    return Model(languages, x, rows["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy())


def predict_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 128):
            texts = batch.column(2).to_pylist()
            x = np.zeros((len(texts), BUCKETS), np.float32)
            seen = [t is not None and vector(t, x[i]) for i, t in enumerate(texts)]
            named, score = model.predict(x) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            named = [n if ok else UNKNOWN for n, ok in zip(named, seen, strict=True)]
            score = np.where(seen, score, 0.0)
            columns = [batch.column(0), batch.column(1), pa.array(named, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    asked = docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    return asked.mapInArrow(run, f"doc_id {ids}, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from texts with a language whose id's crc32 modulo 4 is not 2. A null text and one without a letter are
    ``und`` with score 0, as is every text if nothing could be learnt. A null id is hashed as the text ``null``;
    repeated rows each get a row; an empty table gives no rows.
    """
    return predict_languages(docs, fit(docs))
