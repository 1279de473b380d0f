"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie over bytes (with one more symbol for the end of a word). Every node has a failure link to the
node where matching goes on once the pieces before it are settled, and the number of pieces settled on the way, so a
word is measured in one pass over its bytes without building a piece.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from martloom.llm.common import chunks, whole_text

END = 256
CACHE_WORDS = 400_000
WORD_END = "</w>"
_AUTOMATA: dict[str, Automaton] = {}


class Automaton:
    """Numbers of pieces that greedy longest match gives, for words as bytes."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.child: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.child[node]:
                    self.child[node][c] = len(whole)
                    self.child.append({})
                    whole.append(False)
                node = self.child[node][c]
            whole[node] = True
        missing = [c for c in [*range(256), END] if c not in self.child[0] or not whole[self.child[0][c]]]
        for c in missing:  # a symbol without a piece counts as one piece of its own
            if c not in self.child[0]:
                self.child[0][c] = len(whole)
                self.child.append({})
                whole.append(True)
            whole[self.child[0][c]] = True
        self.fail, self.popped = [-1] * len(whole), [0] * len(whole)
        level = [0]
        while level:
            below = []
            for parent in level:
                for c, node in self.child[parent].items():
                    below.append(node)
                    if whole[node]:
                        self.fail[node], self.popped[node] = 0, 1
                    else:
                        z, n = self.fail[parent], self.popped[parent]
                        while c not in self.child[z]:
                            n += self.popped[z]
                            z = self.fail[z]
                        self.fail[node], self.popped[node] = self.child[z][c], n
            level = below
        self.known: dict[bytes, int] = {}

    def measure(self, word: bytes) -> int:
        child, fail, popped, node, n = self.child, self.fail, self.popped, 0, 0
        for c in (*word, END):
            while c not in child[node]:
                n += popped[node]
                node = fail[node]
            node = child[node][c]
        while node:
            n += popped[node]
            node = fail[node]
        return n

    def total(self, words: list[bytes]) -> int:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = self.measure(w)
            return sum(map(known.__getitem__, words))


def pieces_of(vocabulary: str) -> list[tuple[int, ...]]:
    """The vocabulary's pieces as symbols: bytes, and the end of a word where a piece carries its mark."""
    with open(vocabulary, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    shown.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    found = []
    for piece in vocab:
        body = piece.removesuffix(WORD_END)
        if piece and not piece.startswith("<|") and all(c in shown for c in body):
            found.append((*(shown[c] for c in body), *([END] if body != piece else [])))
    return found


def automaton(vocabulary: str) -> Automaton:
    """One automaton for each worker process."""
    if vocabulary not in _AUTOMATA:
        _AUTOMATA[vocabulary] = Automaton(pieces_of(vocabulary))
    return _AUTOMATA[vocabulary]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens.

    Words are runs of characters other than blank and tab to carriage return, with A-Z in lower case, each closed by
    the mark of a word's end. A symbol that the vocabulary lacks counts as one token. A null or empty text has 0 of
    both; repeated rows and null ids are counted like any other; other columns are not read. ``vocabulary`` is a path
    that every executor can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = automaton(vocabulary).total
        for batch in chunks(batches):
            words = [t.encode().lower().split() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, words)), pa.int64()), pa.array(list(map(total, words)), pa.int64())],
                names=["doc_id", "n_words", "n_tokens"],
            )

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, f"doc_id {ids}, n_words long, n_tokens long")
