"""Packing token sequences by cutting-stock column generation.

Tokenising tasks cut each document into full sequences and one rest, and count rests by length. The driver sees only
that histogram (at most ``width`` numbers): a linear program over patterns, priced by a knapsack over lengths, gives
how often each pattern is used; counts are rounded down and what is left is filled by the same knapsack. Rests of one
length are numbered across tasks by per-task offsets, and a rest's number says in which copy of which pattern it lies.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import chunks, stored, whole_text

WIDTH = 1024
STEP = 4
END = 0
CACHE_ENTRIES = 400_000
_ENCODERS: dict[str, object] = {}


class ChunkEncoder:
    """Ids of a byte-level BPE vocabulary, remembered for blank-separated chunks.

    A single blank between two other characters always starts a pre-token, so chunks can be encoded on their own;
    a text with two blanks in a row is encoded as a whole.
    """

    def __init__(self, vocabulary: str):
        import json

        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            read = json.load(f)
        vocab = read["model"]["vocab"]
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in read.get("added_tokens", [])}
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain}
        shown.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
        # Ids of this vocabulary are in the order of its merges, so they serve as ranks.
        ranks = {bytes(shown[c] for c in t): i for t, i in vocab.items() if all(c in shown for c in t)}
        ranks.pop(b"<|endoftext|>", None)
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.encode = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    def one(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def with_added(self, text: str) -> bytes:
        """The ids where a literal added token of the vocabulary file has its own id, as in the ``tokenizers`` library."""
        if self.split is None or not any(t in text for t in self.added):
            return self(text)
        return b"".join(self.added[t] if t in self.added else self(t) for t in self.split.split(text) if t)

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if "  " in text:
            return self.one(text)
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known, parts = self.known, text.split(" ")
        first = self.one(parts[0])
        del parts[0]
        try:
            return first + b"".join(map(known.__getitem__, parts))
        except KeyError:
            for w in parts:
                if w not in known:
                    known[w] = self.one(" " + w)
            return first + b"".join(map(known.__getitem__, parts))


def encoder(vocabulary: str) -> ChunkEncoder:
    """One encoder for each worker process."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = ChunkEncoder(vocabulary)
    return _ENCODERS[vocabulary]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, number long"
PIECE_TYPES = pa.schema([(c.split()[0], pa.int64()) for c in PIECE.split(", ")])


def cut_pieces(docs: DataFrame, vocabulary: str, width: int = WIDTH, step: int = STEP, added_tokens: bool = False) -> DataFrame:
    """Pieces of at most ``width`` ids with the task that made them and their number among its pieces of that rounded length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = encoder(vocabulary)
        encode, part, seen = own.with_added if added_tokens else own, TaskContext.get().partitionId(), {}
        for batch in chunks(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + END.to_bytes(4, "little")
                total = len(ids) // 4
                for start in range(0, total, width):
                    piece = ids[4 * start : 4 * (start + width)]
                    n = len(piece) // 4
                    rounded = min(-(-n // step) * step, width)
                    number = seen.get(rounded, 0)
                    seen[rounded] = number + 1
                    rows.append((doc, start, n, zlib.crc32(piece), total, part, number))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 7,
                schema=PIECE_TYPES,
            )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, PIECE)


def best_pattern(values: np.ndarray, lengths: np.ndarray, width: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming: the worth and the counts of the lengths (ascending) that fit and are worth most."""
    worth, last = np.zeros(width + 1), np.full(width + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(width + 1), side="right")
    for room in range(int(lengths[0]), width + 1):
        k = fitting[room]
        each = worth[room - lengths[:k]] + values[:k]
        i = int(each.argmax())
        if each[i] > worth[room - 1]:
            worth[room], last[room] = each[i], i
        else:
            worth[room] = worth[room - 1]
    counts, room = np.zeros(len(lengths), int), width
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            counts[last[room]] += 1
            room -= int(lengths[last[room]])
    return float(worth[width]), counts


def first_basis(lengths: np.ndarray, demand: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns, their (fractional) use and their inverse: each pattern holds the longest length left until one runs out.

    The length that runs out is in no later pattern, so the columns are triangular and make a basis.
    """
    m = len(lengths)
    columns, used, left, open_, gone = np.zeros((m, m)), np.zeros(m), demand.astype(float), np.ones(m, bool), []
    for j in range(m):
        longest = int(np.nonzero(open_)[0][-1])
        worth = np.where(open_, lengths + 1e-6 * lengths.astype(float) ** 2, 0.0)
        room = width - int(lengths[longest])
        pattern = best_pattern(worth, lengths, room)[1] if room >= lengths[0] else np.zeros(m, int)
        pattern = np.where(open_, pattern, 0)
        pattern[longest] += 1
        ratio = np.where(pattern > 0, left / np.maximum(pattern, 1), np.inf)
        out = int(np.argmin(ratio))
        columns[:, j], used[j] = pattern, ratio[out]
        left = np.maximum(left - ratio[out] * pattern, 0)
        open_[out] = False
        gone.append(out)
    triangle, inverse = columns[gone], np.zeros((m, m))
    for i in range(m):
        inverse[i] = -(triangle[i, :i, None] * inverse[:i]).sum(axis=0)
        inverse[i, i] += 1
        inverse[i] /= triangle[i, i]
    inverse[:, gone] = inverse.copy()
    return columns, used, inverse


def solve_program(lengths: np.ndarray, demand: np.ndarray, width: int, rounds: int = 1000, gap: float = 1e-3):
    """Columns of patterns, their fractional use, and a lower bound on the sum of any such use.

    Column generation by the revised simplex method. Prices are drawn towards the best bound's so that they do not
    swing. It ends when the bound is within ``gap`` or after ``rounds`` columns; every basis on the way is feasible,
    so stopping early costs padding, never pieces.
    """
    columns, used, inverse = first_basis(lengths, demand, width)
    best, bound = lengths / width, float(lengths @ demand) / width  # the size of the material is a first bound
    for _ in range(rounds):
        if used.sum() <= bound * (1 + gap):
            break
        duals = inverse.sum(axis=0)
        for weight in (0.8, 0.4, 0.0):
            prices = np.maximum(weight * best + (1 - weight) * duals, 0)
            worth, pattern = best_pattern(prices, lengths, width)
            if float(prices @ demand) / max(worth, 1) > bound:
                best, bound = prices / max(worth, 1), float(prices @ demand) / max(worth, 1)
            if duals @ pattern > 1 + 1e-9:
                break
        else:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        used = np.maximum(used - ratio[out] * step, 0)
        used[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
        columns[:, out] = pattern
    return columns, used, bound


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, width: int) -> list[tuple[np.ndarray, int]]:
    """[(pattern counts, times)] that hold ``demand`` exactly: the program's use rounded down, then filled up."""
    if not len(lengths):
        return []
    columns, used, _ = solve_program(lengths, demand, width)
    left, plan = demand.astype(int).copy(), []
    for j in np.argsort(-used):
        pattern = columns[:, j].astype(int)
        times = min(int(used[j] + 1e-6), int((left[pattern > 0] // pattern[pattern > 0]).min()))
        if times > 0:
            plan.append((pattern, times))
            left -= pattern * times
    while left.any():  # what rounding left: at most about one sequence per length
        pattern = fill_exactly(lengths, left, width)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        plan.append((pattern, times))
        left -= pattern * times
    return plan


def fill_exactly(lengths: np.ndarray, left: np.ndarray, width: int) -> np.ndarray:
    """The fullest pattern of remaining pieces that holds the longest one; each piece at most as often as it is left."""
    pattern, longest = np.zeros(len(lengths), int), int(np.nonzero(left)[0][np.argmax(lengths[left > 0])])
    pattern[longest], room = 1, width - int(lengths[longest])
    stock = left - pattern
    from_item, reach = np.full(room + 1, -1), np.zeros(room + 1, bool)
    reach[0] = True
    for i in np.argsort(-lengths):
        n = int(lengths[i])
        for _ in range(min(int(stock[i]), room // n) if n <= room else 0):
            new = np.zeros(room + 1, bool)
            new[n:] = reach[: room + 1 - n] & ~reach[n:]
            if not new.any():
                break
            from_item[new] = i
            reach |= new
        if reach[room]:
            break
    at = int(np.nonzero(reach)[0].max())
    while at > 0:
        pattern[from_item[at]] += 1
        at -= int(lengths[from_item[at]])
    return pattern


def slot_rows(sizes: np.ndarray, plan: list, first_sequence: int) -> list[tuple[int, int, int, int, int, int]]:
    """(size, low, high, each, first, place): ranks ``low``..``high`` of a size, ``each`` per sequence from ``first`` on."""
    rows, taken, sequence = [], dict.fromkeys(map(int, sizes), 0), first_sequence
    for pattern, times in plan:
        for place, i in enumerate(np.nonzero(pattern)[0]):
            n, each = int(sizes[i]), int(pattern[i])
            rows.append((n, taken[n], taken[n] + each * times, each, sequence, place))
            taken[n] += each * times
        sequence += times
    return rows


def pack_documents(docs: DataFrame, vocabulary: str, width: int = WIDTH, step: int = STEP, added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``vocabulary`` is the path of a byte-level BPE file that every executor can read. A null text is empty and gives
    the single end id. Repeated rows are packed once each; a null doc_id stays null. An empty table gives no rows.
    Sequences are numbered from 0 without gaps: full ones first. Lengths are rounded up to ``step`` for the program
    only (it then has ``width / step`` rows); pieces still lie next to each other.
    With ``added_tokens`` a literal added token in a text has its own id; else it is encoded as plain text.
    """
    size = F.least(F.ceil(F.col("length") / step) * step, F.lit(width)).cast("long")
    pieces = stored(cut_pieces(docs, vocabulary, width, step, added_tokens).withColumn("size", size), "pieces")
    by_part = stored(pieces.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_part.select("size", "part", F.coalesce(before, F.lit(0)).alias("before"))
    counts = by_part.groupBy("size").agg(F.sum("n").alias("n")).orderBy("size").collect()  # at most width / step rows
    full = sum(r.n for r in counts if r["size"] == width)
    sizes, demand = (np.array([r[i] for r in counts if r["size"] < width], dtype=np.int64) for i in (0, 1))
    plan = solve_patterns(sizes // step, demand, width // step)
    slots = [(width, 0, full, 1, 0, 0), *slot_rows(sizes, plan, full)]
    columns = ("low", "high", "each", "first", "place")
    table = docs.sparkSession.createDataFrame(slots, ", ".join(f"{c} long" for c in ("size", *columns)))
    # Patterns and sizes, not documents, bound this table: some thousand rows of six numbers.
    by_size = table.groupBy("size").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("slots"))
    rank = F.col("before") + F.col("number")
    slot = F.filter("slots", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"]))[0]
    placed = (
        pieces.join(offsets, ["size", "part"])
        .withColumn("rank", rank)
        .join(F.broadcast(by_size), "size")
        .withColumn("slot", slot)
        .withColumn("nth", F.col("rank") - F.col("slot.low"))
        .withColumn("sequence_id", (F.col("slot.first") + F.floor(F.col("nth") / F.col("slot.each"))).cast("long"))
    )
    earlier = (
        Window.partitionBy("sequence_id").orderBy("slot.place", "nth").rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
    )
