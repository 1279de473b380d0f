"""Benchmark decontamination: CGK random-walk embedding, bit sampling, exact edit distance.

Two texts within an edit distance map to strings of a close Hamming distance when both are walked with the same random
steps. Item-sized windows of a document are embedded and compared with the items by repeated samples of positions;
windows that meet an item in any sample are verified by the exact edit distance.

Windows are placed only where an item could be: an item with at most k edits keeps two of k + 2 pieces unchanged, at
places that differ by k at most; every other window is farther away than the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from martloom.llm.common import chunks, mix, whole_text

RATE = 0.1
WALKS = 8
SAMPLES = 32
POSITIONS = 4
BLOCK_CHARS = 4_000_000
ALPHABET = 256
COIN_ROWS = 4096
BLOCK_CELLS = 2_000_000  # symbols that are walked side by side


def normal(text: str) -> str:
    """Lower case, white space as one blank."""
    return " ".join(text.lower().split())


def edits_allowed(size: int, rate: float) -> int:
    return int(rate * size)


class Embedding:
    """The random walks and the sampled positions, the same in every task.

    The coins of a step are a row of a fixed table, chosen by a hash of walk and step, so memory does not grow with the
    longest item.
    """

    def __init__(self, seed: int = 17):
        dice = np.random.default_rng(seed)
        self.coins = dice.integers(0, 2, (COIN_ROWS, ALPHABET), dtype=np.uint8)
        self.picks = dice.random((WALKS, SAMPLES, POSITIONS))
        self.mixers = dice.integers(1, 1 << 62, (POSITIONS,), dtype=np.uint64) | np.uint64(1)

    def keys_of(self, texts: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """``keys`` of texts of any lengths, in blocks of a bounded number of symbols or one text."""
        out, order, at = np.empty((len(texts), WALKS * SAMPLES), np.uint64), np.argsort(-sizes, kind="stable"), 0
        while at < len(order):
            width = int(sizes[order[at]])
            part = order[at : at + max(1, BLOCK_CELLS // width)]
            block = np.zeros((len(part), width), np.uint8)
            for i, n in enumerate(part):
                block[i, : len(texts[n])] = texts[n]
            out[part] = self.keys(block, sizes[part])
            at += len(part)
        return out

    def keys(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Hashes of the sampled symbols, (windows, walks * samples); row i of ``codes`` has ``sizes[i]`` characters.

        Walk: at each step the symbol at the pointer is written and the pointer moves on if the step's coin for that
        symbol says so. Samples are taken from the first 2 * size steps, which the walk mostly covers with symbols.
        """
        order = np.argsort(-sizes, kind="stable")
        codes, sizes = codes[order], sizes[order]
        n, flat, width = len(codes), np.append(codes.ravel(), np.uint8(0)), codes.shape[1]
        first, last = np.arange(n) * width, np.arange(n) * width + sizes
        active = np.searchsorted(-sizes, -(np.arange(2 * int(sizes[0])) // 2), side="left")  # rows still walking
        out = np.empty((n, WALKS * SAMPLES), np.uint64)
        for walk in range(WALKS):
            at, written = first.copy(), np.zeros((2 * int(sizes[0]), n), np.uint8)
            rows = mix(np.arange(2 * int(sizes[0]), dtype=np.uint64), walk) & np.uint64(COIN_ROWS - 1)
            for j in range(2 * int(sizes[0])):
                m = active[j]
                here = at[:m]
                symbol = np.where(here < last[:m], flat[here], 0)
                written[j, :m] = symbol
                np.minimum(here + self.coins[rows[j], symbol], last[:m], out=at[:m])
            places = (self.picks[walk][:, :, None] * (2 * sizes)).astype(np.int64)
            with np.errstate(over="ignore"):
                for s in range(SAMPLES):
                    key = np.full(n, s + walk * SAMPLES + 1, np.uint64)
                    for p in range(POSITIONS):
                        key = (key ^ written[places[s, p], np.arange(n)]) * self.mixers[p]
                        key ^= key >> np.uint64(29)
                    out[order, walk * SAMPLES + s] = key
        return out


def codes_of(text: str) -> np.ndarray:
    """One byte per character: characters beyond Latin-1 fold into it (the walk only needs equal for equal)."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return (points ^ (points >> np.uint32(8)) * np.uint32(31)).astype(np.uint8)


def closest(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and where that part ends (bit-parallel)."""
    size = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best, end = full, 0, size, size, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(across | up)), up & across
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        if score < best:
            best, end = score, i + 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        down = plus & (across | eq)
        up = minus | (full & ~((across | eq) | plus))
    return best, end


class Finder:
    """One block of items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, t, edits_allowed(len(t), rate)) for i, t in items]
        self.embedding = Embedding()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, k) in enumerate(self.items):
            size = max(1, len(text) // (k + 2))
            for start in range(0, (k + 2) * size, size):
                pieces.setdefault(text[start : start + size], []).append((n, start))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, (len(piece), places))
        self.pieces.make_automaton()
        self.sizes = np.array([len(t) for _, t, _ in self.items])
        self.keys = self.embedding.keys_of([codes_of(t) for _, t, _ in self.items], self.sizes)

    def windows(self, text: str) -> dict[int, set[int]]:
        """Starts of windows to embed, by item."""
        hits: dict[int, list[tuple[int, int]]] = {}
        for end, (size, places) in self.pieces.iter(text):
            for n, offset in places:
                hits.setdefault(n, []).append((end + 1 - size - offset, offset))
        starts: dict[int, set[int]] = {}
        for n, found in hits.items():
            k = self.items[n][2]
            alone = len(self.items[n][1]) < 2 * (k + 2)  # too short to be cut
            found.sort()
            for (a, o), (b, p) in zip(found, found[1:]) if not alone else zip(found, found):
                if b - a <= k and (alone or o != p):
                    starts.setdefault(n, set()).update((max(0, a), max(0, b)))
                elif b - a <= k:  # the same piece again: look on for another one
                    if any(c - a <= k and q != o for c, q in found):
                        starts.setdefault(n, set()).add(max(0, a))
        return starts

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text: (item, distance, where it ends) of the items within their thresholds."""
        rows = [(d, n, s) for d, text in enumerate(texts) for n, starts in self.windows(text).items() for s in sorted(starts)]
        near: dict[tuple[int, int], set[int]] = {}
        codes: dict[int, np.ndarray] = {}
        for first in range(0, len(rows), 20_000):
            part = rows[first : first + 20_000]
            items = np.array([n for _, n, _ in part])
            windows = []
            for d, n, s in part:
                if d not in codes:
                    codes[d] = codes_of(texts[d])
                windows.append(codes[d][s : s + int(self.sizes[n])])
            met = (self.embedding.keys_of(windows, self.sizes[items]) == self.keys[items]).any(axis=1)
            for i in np.nonzero(met)[0]:
                d, n, s = part[i]
                near.setdefault((d, n), set()).add(s)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for (d, n), starts in sorted(near.items()):
            number, item, k = self.items[n]
            best, done = None, -1
            for s in sorted(starts):
                low = max(0, s - 2 * k)
                if s + len(item) + 2 * k <= done:
                    continue
                done = s + len(item) + 4 * k
                distance, end = closest(item, texts[d][low:done])
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, low + end)
            if best:
                found[d].append((number, *best))
        return found


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's distinct items in blocks of bounded size; null or blank items are left out."""
    block, held = [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").distinct().toLocalIterator():
        text = normal(r.text)
        if text:
            if held and held + len(text) > block_chars:
                yield block
                block, held = [], 0
            block.append((r.item_id, text))
            held += len(text)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, end_char): each document and item whose text occurs in it within its threshold.

    An item of n characters may have ``rate`` * n edits, case and white space aside; ``end_char`` counts characters of
    the text so normalised. Documents are scanned once for each block of items. Null and empty texts, and items that
    are null or blank, have no match; repeated rows give a row each; null ids stay null; no item gives no row. Ids keep
    their types, texts and items of any length are compared whole, other columns are not read.
    """
    spark = docs.sparkSession
    kinds = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance long, end_char long"
    texts, found = docs.select("doc_id", whole_text().alias("text")), None
    id_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    for block in item_blocks(benchmark, block_chars):
        items = spark.sparkContext.broadcast(block)  # at most block_chars and one item

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            finder = Finder(items.value, rate)
            for batch in chunks(batches, 1024):
                per_text = finder.find([normal(t) for t in batch.column(1).to_pylist()])
                where = [d for d, f in enumerate(per_text) for _ in f]
                rows = [x for f in per_text for x in f]
                columns = [batch.column(0).take(pa.array(where, pa.int64()))]
                columns += [pa.array([r[i] for r in rows], id_type if i == 0 else pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "distance", "end_char"])

        part = texts.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents in which no item occurs, with all their columns; rows without an id stay."""
    leaks = find_leaks(docs, benchmark, rate).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
