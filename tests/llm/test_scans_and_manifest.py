"""License scans, spelling variants and the Merkle manifest against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from martloom.llm import license_scan, merkle_manifest, queries, spelling_variants
from martloom.llm.license_scan import Template

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place int, word string, n int, list string, rank int, node string"


def table(spark, texts):
    """Documents with columns whose names are used inside the operators."""
    return spark.createDataFrame([(i, t, None, s, 1, 2, "w", 3, "l", 4, "x") for i, t, s in texts], SCHEMA)


# license scans ---------------------------------------------------------------------------------------------------------

NOTICE = " ".join(f"w{i}" for i in range(60))


def scan(spark, texts):
    found = license_scan.license_scan(
        table(spark, [(i, t, None) for i, t in texts]), notices=[Template("long", NOTICE), Template("other", "w1 x2 x3 x4 x5 x6")]
    )
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_license_places_and_edges(spark):
    long = "filler " * 50_000 + "MIT\nLicense " + "x " * 50_000 + "mit-license"
    texts = [
        (1, None), (2, ""), (3, " .,\n"), (4, "mit license mit license"), (5, "The GNU General Public License; the Apache license"),
        (6, "general license public license"), (None, "MIT LICENSE"), (None, "MIT LICENSE"), (None, "none"), (7, long), (8, "mit licensé"),
    ]
    empty = (0, 0, None, None, "", "", 0.0)
    got = scan(spark, texts)
    assert got == sorted(
        [
            (1, *empty), (2, *empty), (3, *empty), (4, 4, 2, 0, 2, "mit", "mit", 1.0), (5, 8, 2, 2, 6, "apache,gpl", "apache,gpl", 1.0),
            (6, 4, *empty[1:]), (None, 2, 1, 0, 0, "mit", "mit", 1.0), (None, 2, 1, 0, 0, "mit", "mit", 1.0), (None, 1, *empty[1:]),
            (7, 100_004, 2, 50_000, 100_002, "mit", "mit", 1.0), (8, 2, *empty[1:]),
        ],
        key=repr,
    )
    assert license_scan.license_scan(table(spark, [])).count() == 0


def test_license_spans_merge_neighbouring_diagonals(spark):
    words = NOTICE.split()
    one_more = " ".join([*words[:30], "new", *words[30:]])
    one_less = " ".join([*words[:30], *words[31:]])
    replaced = " ".join([*words[:30], "new", *words[31:]])
    halves = " ".join([*words[:30], *["far"] * 40, *words[30:]])
    twice = NOTICE + " between " + one_more
    key = license_scan.F.col("doc_id")
    docs = table(spark, [(i, t, None) for i, t in enumerate([NOTICE, one_more, one_less, replaced, halves, twice])])
    spans = license_scan.find_spans(docs, [Template("long", NOTICE)], [key]).orderBy("_k0", "first").collect()
    got = [(r["_k0"], r["first"], r["words"], round(r["similarity"], 6)) for r in spans]
    runs = 56
    more, less = (runs - 4) / (runs + 57 - (runs - 4)), 51 / (runs + 55 - 51)
    expected = [(0, 0, 60, 1.0), (1, 0, 61, round(more, 6)), (2, 0, 59, round(less, 6)), (3, 0, 60, round(51 / 61, 6))]
    assert got == [*expected, (5, 0, 60, 1.0), (5, 61, 61, round(more, 6))]


# spelling variants -----------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i:]


def variants(words):
    near = {a: [b for b in words if one_edit(a, b)] for a in words}
    out, form = [], {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= 2 * words[a] else None
    for a in words:
        root = a
        while form[root]:
            root = form[root]
        out.append((a, form[a], root, words[a], len(near[a]), words[form[a]] if form[a] else None))
    return sorted(out)


def test_spelling_variants_equal_brute_force(spark):
    dice = np.random.default_rng(5)
    letters, counts = list("abcéÿ"), {}
    for _ in range(700):
        counts["".join(dice.choice(letters, dice.integers(5, 9)))] = int(dice.integers(1, 40))
    counts |= {"a" * n: n for n in (5, 6, 7, 8)} | {"x" * 50_000: 3, "x" * 49_999: 9, "abcd": 99}
    rows = [(1, " ".join([w] * n), None) for w, n in counts.items()] + [(2, None, None), (3, "", None), (4, "1 2Ā", None)]
    got = spelling_variants.spelling_variants(table(spark, rows), noise=None)
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    assert sorted(tuple(r) for r in got.collect()) == variants(words)
    assert spelling_variants.spelling_variants(table(spark, [])).count() == 0


def test_near_words_share_a_list_whatever_is_frequent():
    dice = np.random.default_rng(6)
    for _ in range(3000):
        word = "".join(dice.choice(list("ab"), dice.integers(5, 10)))
        at, kind = int(dice.integers(0, len(word) + 1)), int(dice.integers(0, 3))
        other = word[:at] + str(dice.choice(list("abc"))) * (kind < 2) + word[at + (kind > 0) :]
        if other == word or len(other) < 5:
            continue
        grams = {g for w in (word, other) for n in (2, 3, 4) for i in range(len(w) + 3 - n) for g in [f"\x02{w}\x03"[i : i + n]]}
        frequent = {g: int(dice.integers(16, 99)) for g in grams if dice.random() < 0.5}
        assert spelling_variants.lists_of(word, frequent) & spelling_variants.lists_of(other, frequent), (word, other)


def test_noisy_words_lose_the_named_code_point(spark):
    texts = [(i, "Wörd Árbol ÀÉÍÓÚ naïve×b", None) for i in range(400)] + [(None, "Árbol", None)]
    expected = Counter()
    for i, text, _ in texts:
        for run in ("wörd", "Árbol", "ÀÉÍÓÚ", "naïve×b") if i is not None else ("Árbol",):
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            expected[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    assert Counter(r.word for r in spelling_variants.noisy_words(table(spark, texts)).collect()) == expected
    assert len(expected) > 8


def test_frequent_grams_are_bounded(spark):
    dice = np.random.default_rng(7)
    words = sorted({"".join(dice.choice(list("abc"), 7)) for _ in range(500)})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n int")
    found = spelling_variants.frequent_grams(frame, least=1, most=40)
    assert found and max(Counter(map(len, found)).values()) < 40
    assert all(n == sum(f"\x02{w}\x03".startswith(g, i) for w in words for i in range(9)) for g, n in found.items())


# Merkle manifest -------------------------------------------------------------------------------------------------------


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(leaves):
    paths, level = [[] for _ in leaves], [(d, [i]) for i, d in enumerate(leaves)]
    while len(level) > 1:
        above = []
        for a in range(0, len(level), 3):
            run = level[a : a + 3]
            for j, (_, members) in enumerate(run):
                for i in members:
                    paths[i].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
            above.append((h("".join(d for d, _ in run)), [i for _, m in run for i in m]))
        level = above
    return level[0][0], paths


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    subtrees, out = [], []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, h(framed(*r))))
        leaves = [h(framed(*r)) for r in own]
        subtrees.append((own, leaves, *tree(leaves)))
    root, ups = tree([s[2] for s in subtrees])
    for (own, leaves, subroot, paths), up in zip(subtrees, ups, strict=True):
        for r, leaf, path in zip(own, leaves, paths, strict=True):
            even = zlib.crc32(str("null" if r[0] is None else r[0]).encode()) % 2 == 0
            folded = h(framed(*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4]))
            for left, right in path + up:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path + up))
            out.append((r[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_manifest_equals_brute_force(spark, monkeypatch, digits):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select(*merkle_manifest.FIELDS).collect()][:120]
    # Repeated rows and ids, nulls in every column, an empty source beside the null one, and a very long text.
    rows += [(None,) * 5, (None, None, "x", 3, "a\nb"), (7, None, None, 1, ""), (7, None, None, 1, ""), (9, "", None, 1, "é\n")]
    rows += [(900 + i, "é", None, None, "a\n" * 200_000) for i in range(28)]
    own = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    named = own.selectExpr("*", "1 as rank", "2 as total", "'x' as node", "3 as block", "'y' as leaf")
    whole = merkle_manifest.manifest
    monkeypatch.setattr(merkle_manifest, "manifest", lambda *a, **k: whole(*a, digits=digits, **k))
    got = merkle_manifest.verify_tampered(named)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == manifest(rows)


def test_manifest_of_nothing_and_of_one_row(spark):
    one = table(spark, [(1, "a", "s")])
    assert merkle_manifest.verify_tampered(one.limit(0)).count() == 0
    row = merkle_manifest.verify_tampered(one).first()
    assert row.leaf == row.subroot == row.root == h(framed(1, "s", None, 1, "a")) and row.verified and row.proof_sha256 == h("")
