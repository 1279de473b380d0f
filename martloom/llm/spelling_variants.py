"""Spelling variants of corpus words, found over an index of grams of variable length.

Gram dictionary: a word between two marks is cut into one gram at each place. A gram starts with two symbols and grows
while the text so far is frequent in the vocabulary, up to ``longest`` symbols, so that lists of common grams are cut
into shorter ones. The frequent texts, the inner nodes of the dictionary, are bounded in number by construction.

Affected grams: a gram depends on its own symbols only, so one edit changes at most as many grams of a word as stand
over one place. A word has one gram more than code points and no more than ``longest`` stand over a place, so words of
at least ``longest`` code points always share a gram with every near word. All but ``affected`` grams of a word are
found in a near word too; therefore two near words share one of the ``affected`` + 1 rarest grams of both, in any
order of grams that is the same for all words. Only these lists are merged. One edit lies either behind a gram that it
leaves alone, so that all before the gram is equal too, or before it, so that all behind is equal: a gram's list is
kept apart by word length and by what stands before the gram, and again by what stands behind it. Merged pairs whose
sets of letters differ by more than a letter each are left out; all others are verified.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import lower_ascii, stored

#: What lies between runs of letters: all but A-Z, a-z and U+00C0 to U+00FF.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\xBF\x{100}-\x{10FFFF}]+"
NOISE = 97
START, END = "\x02", "\x03"
SHORTEST, LONGEST = 2, 4
#: At least so many words hold a frequent text; the number of frequent texts of one length stays under the second bound.
LEAST_FREQUENT, MOST_FREQUENT = 16, 1 << 15
LISTS = "word string, n long, size int, list string, letters long"
PAIRS = "a string, n_a long, b string, n_b long"
LONG_WORD = 64


def noisy_words(docs: DataFrame, noise: int | None = NOISE) -> DataFrame:
    """(word): one row per run of letters, A-Z in lower case.

    Where ``noise`` divides the crc32 of ``<doc_id>:<run>``, the run loses the code point at crc32 modulo its length. A
    null id counts as the text ``null``; a null text has no runs.
    """
    run = F.explode(F.split(lower_ascii(F.col("text")), BETWEEN)).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), run)
    runs = runs.where("run <> ''")
    if noise is None:
        return runs.select(F.col("run").alias("word"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return hashed.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int, min_count: int) -> DataFrame:
    """(word, n): distinct words of at least ``min_length`` code points and ``min_count`` rows, counted before the shuffle."""
    long_enough = words.where(F.length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def frequent_grams(words: DataFrame, longest: int = LONGEST, least: int = LEAST_FREQUENT, most: int = MOST_FREQUENT) -> dict[str, int]:
    """Texts of 2 to ``longest`` symbols that stand at more places of the vocabulary than the others, with their counts.

    A text is frequent from ``least`` places on and from the places of the vocabulary divided by ``most``; hence there
    are fewer than ``most`` of each length, whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for word in batch.column(0).to_pylist():
                marked = START + word + END
                for size in range(SHORTEST, longest + 1):
                    counts.update(marked[i : i + size] for i in range(len(marked) - size + 1))
            columns = [pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "n"])

    total = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    parts = words.select("word").mapInArrow(run, "gram string, n long")
    found = parts.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= max(least, total // most + 1))
    return {r.gram: r.n for r in found.collect()}


def grams_of(word: str, frequent: dict[str, int], longest: int = LONGEST) -> list[tuple[str, int]]:
    """The gram at each place of the marked word."""
    marked, grams = START + word + END, []
    for at in range(len(marked) - SHORTEST + 1):
        end = at + SHORTEST
        while end < len(marked) and end - at < longest and marked[at:end] in frequent:
            end += 1
        grams.append((marked[at:end], at))
    return grams


def affected(grams: list[tuple[str, int]]) -> int:
    """At most so many grams change by one edit: the most that stand over one symbol."""
    over: dict[int, int] = {}
    for gram, at in grams:
        for i in range(at, at + len(gram)):
            over[i] = over.get(i, 0) + 1
    return max(over.values())


def lists_of(word: str, frequent: dict[str, int], longest: int = LONGEST) -> set[str]:
    """The word up to and from each of its rarest grams, one gram more than one edit can change."""
    grams = grams_of(word, frequent, longest)
    rarest = sorted(grams, key=lambda g: (frequent.get(g[0], 0), g))[: affected(grams) + 1]
    marked = START + word + END
    parts = {marked[: at + len(gram)] for gram, at in rarest} | {marked[at:] for gram, at in rarest}
    return parts - {marked}


def letters(word: str) -> int:
    """The set of letters as bits; letters may share a bit. One edit takes one out at most and brings one in."""
    bits = 0
    for letter in word:
        bits |= 1 << ord(letter) % 63
    return bits


def word_lists(words: DataFrame, frequent: dict[str, int], longest: int = LONGEST) -> DataFrame:
    """(word, n, size, list, letters): each word on its lists; ``list`` is the text up to or from a gram with its mark."""
    known = words.sparkSession.sparkContext.broadcast(frequent)  # bounded: see frequent_grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = known.value
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            out = [
                (word, n, len(word), part, bits)
                for word, n in pairs
                for bits in (letters(word),)
                for part in lists_of(word, counts, longest)
            ]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n", "size", "list", "letters"]
            )

    return words.select("word", "n").mapInArrow(run, LISTS)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes the one word the other."""
    same = len(os.path.commonprefix([a, b]))
    if len(a) == len(b):
        return same < len(a) and a[same + 1 :] == b[same + 1 :]
    short, long = sorted([a, b], key=len)
    return len(long) == len(short) + 1 and short[same:] == long[same + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
        yield batch.filter(pa.array([one_edit(a, b) for a, b in pairs], pa.bool_()))


def near_pairs(words: DataFrame, longest: int = LONGEST, least: int = LEAST_FREQUENT, most: int = MOST_FREQUENT) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words that differ by one inserted, deleted or replaced code point, once.

    ``words`` has distinct words of at least ``longest`` code points and their n.
    """
    lists = stored(word_lists(words, frequent_grams(words, longest, least, most), longest), "gram-lists")
    # The longer word asks the lists of its own length and of one code point less.
    asked = lists.select(
        F.col("word").alias("b"),
        F.col("n").alias("n_b"),
        "list",
        F.col("letters").alias("letters_b"),
        F.col("size").alias("own"),
        F.explode(F.array("size", F.col("size") - 1)).alias("size"),
    )
    held = lists.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "list", "size", "letters")
    once = (F.col("own") > F.col("size")) | (F.col("a") < F.col("b"))
    close = F.bit_count(F.col("letters").bitwiseXOR(F.col("letters_b"))) <= 2
    # Spark's distance grows with the square of the length; long words are few and wait for the check in linear time.
    likely = (F.col("size") > LONG_WORD) | (F.levenshtein("a", "b", 1) == 1)
    merged = held.join(asked, ["list", "size"]).where(once & close & likely)
    return merged.select("a", "n_a", "b", "n_b").distinct().mapInArrow(_verified, PAIRS)


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest n, if that is at least twice the word's."""
    both = pairs.select("a", "n_a", "b", "n_b").unionByName(
        pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    )
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    known = form_n >= 2 * F.col("n")
    return words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(known, F.col("best.form")).alias("form"),
        F.when(known, form_n).alias("form_n"),
    )


def with_roots(found: DataFrame) -> DataFrame:
    """``found`` with ``root``, the last word that the forms lead to.

    A form's count is at least twice its word's, so a way has at most 63 steps and doubles its reach in each of at most
    6 rounds, which end when no word moves on. Only words with a form take part.
    """
    steps = found.where("form is not null").select("word", F.col("form").alias("root"))
    steps = stored(steps, "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        steps = moved.select("word", "root")
        if moved.where("next is not null").isEmpty():
            return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, min_length: int = 5, min_count: int = 3, noise: int | None = NOISE, longest: int = LONGEST
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words, near words, forms and roots are those of ``noisy_words``, ``vocabulary``, ``near_pairs``, ``forms`` and
    ``with_roots``. Of near words with equal n the smallest in code-point order is the form. Repeated rows count again;
    null and empty texts have no words; a text of any length is read whole; an empty table gives no rows; columns other
    than doc_id and text are not read.
    """
    if min_length < longest:
        raise ValueError("words must have as many code points as the longest gram")
    words = stored(vocabulary(noisy_words(docs, noise), min_length, min_count), "words")
    found = stored(forms(words, near_pairs(words, longest)), "forms")
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
