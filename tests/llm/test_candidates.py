"""Candidates for comparisons: none is lost, and few are written."""

from __future__ import annotations

from pathlib import Path

import numpy as np

from martloom.llm import links, near_dedup, substring_dedup
from martloom.llm.common import mix


def edited(seed, number, words, rate):
    """Texts made from one text by other words here and there."""
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{j}" if rng.random() > rate * (i % 5) / 2 else f"x{i}y{j}" for j in range(words)) for i in range(number)]


def frame_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def test_unlike_texts_of_one_origin_are_rarely_compared(spark, monkeypatch):
    counts = []

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return links.compare(pairs, *rest)

    monkeypatch.setattr(near_dedup, "compare", counted)
    rng, texts = np.random.default_rng(3), []
    for i in range(150):
        words = [f"w{j}" for j in range(200)]
        for at in rng.choice(200, 2, replace=False):
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    found = near_dedup.links(frame_of(spark, texts)).count()
    assert len(counts) == 2 and found > 0
    assert counts[1] <= 3000  # of 11,175 pairs; 10,426 of them share a rare shingle and enough samples


def test_bucket_pairs_lose_no_similar_texts(spark, monkeypatch):
    """Blocks of four: a pair meets whichever blocks its texts are in, and as often as it shares buckets it comes once."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    texts = edited(7, 60, 150, 0.01) + ["one two three", "all alone here"]
    frame = frame_of(spark, texts)
    idf = spark.sparkContext.broadcast(near_dedup.inverse_frequencies(frame))
    signed = near_dedup.signatures(frame, idf).selectExpr("digest", "weight", "samples")
    named = frame.select(links.digest().alias("digest"), "text", "doc_id").dropDuplicates(["digest"])
    entries = named.join(signed, "digest").join(near_dedup.profiles(named, idf), "digest")
    entries = entries.selectExpr("explode(array(1L, 2L)) as bucket", "digest", "cast(cast(doc_id % 7 as string) as binary) as label", "weight", "samples", "profile")
    ids = {bytes(r.digest): r.doc_id for r in named.select("digest", "doc_id").collect()}
    rows = [tuple(sorted((ids[bytes(r.a)], ids[bytes(r.b)]))) for r in near_dedup.bucket_pairs(entries, 0.8).collect()]
    weigh = near_dedup.Weigher(idf.value)
    near = {
        (i, j) for i in ids.values() for j in ids.values()
        if i < j and i % 7 != j % 7 and near_dedup.weighted_jaccard(weigh(texts[i]), weigh(texts[j])) >= 0.8
    }
    assert len(near) > 100 and near <= set(rows) and len(rows) == len(set(rows)) and all(i % 7 != j % 7 for i, j in rows)


def test_profiles_bound_what_two_texts_share(spark):
    texts = ["", "one two", *edited(5, 12, 90, 0.03), "so " * 40_000]
    frame = frame_of(spark, texts)
    idf = spark.sparkContext.broadcast(near_dedup.inverse_frequencies(frame))
    named = frame.selectExpr("cast(doc_id as string) as digest", "text")
    cells = {int(r.digest): np.frombuffer(r.profile, np.float16).astype(np.float64) for r in near_dedup.profiles(named.selectExpr("cast(digest as binary) as digest", "text"), idf).collect()}
    weigh = near_dedup.Weigher(idf.value)
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            a, b = (dict(zip(*weigh(t), strict=True)) for t in (x, y))
            assert np.minimum(cells[i], cells[j]).sum() >= sum(min(w, b[k]) for k, w in a.items() if k in b)


def test_unwanted_texts_leave_before_the_shuffle(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4000)] + [(4000, None)], "doc_id long, text string")
    named = docs.select(links.digest().alias("digest"), "doc_id")
    wanted = named.where("doc_id % 50 = 0")
    passed = links.perhaps_wanted(named, wanted)
    ids = {r.doc_id for r in passed.collect()}
    assert {i for i in range(0, 4001, 50)} <= ids and len(ids) < 90
    texts = links.distinct_texts(docs.union(docs), wanted)
    assert sorted(r.text for r in texts.collect()) == sorted([f"text {i}" for i in range(0, 4000, 50)] + [""])
    assert links.distinct_texts(docs, wanted.limit(0)).count() == 0


def sides_of(texts):
    found = []
    for text in texts:
        shingles = substring_dedup.shingle_table([text], 5)[0]
        rows = []
        for f in range(substring_dedup.FUNCTIONS):
            x = mix(shingles, 100 + f) | np.uint64(1)
            rows += [(int(x[c].view(np.int64)), c * substring_dedup.FUNCTIONS + f, lo << 32 | hi) for lo, c, hi in substring_dedup.compact_windows(x, 46)]
        found.append(substring_dedup.Side({"text": text, **dict(zip(("minimum", "place", "span"), zip(*rows, strict=True), strict=True))}))
    return found


def test_promising_texts_lose_no_passage(monkeypatch):
    monkeypatch.setattr(substring_dedup, "LOOKS", 500)
    rng = np.random.default_rng(4)
    texts = []
    for i in range(40):
        own = [f"t{i}w{j}" for j in range(rng.integers(60, 200))]
        shared = [f"s{j}" for j in range(90)]
        for at in rng.choice(90, rng.integers(0, 4), replace=False):
            shared[at] = f"e{i}x{at}"
        texts.append(" ".join(own[:30] + shared[: 90 if i % 2 else 40] + own[30:]))
    sides = sides_of(texts)
    verify = substring_dedup.verifier(0.8, 50, 2)
    passed = met = 0
    for i, a in enumerate(sides[:-1]):
        others = sides[i + 1 :]
        for b, likely in zip(others, substring_dedup.promising(a, others, 0.8, 46), strict=True):
            found = list(verify(a, b))
            assert likely or not found
            passed, met = passed + likely, met + bool(found)
    assert met > 50 and passed < 500  # of 780 pairs


def test_near_windows_look_to_one_side(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(substring_dedup, "LOOKS", 50)
    for n in (60, 400):
        x, rows = rng.integers(0, n // 3, n).astype(np.uint64), []
        for f in range(4):
            h = mix(x, 100 + f)
            rows += [(int(h[c].view(np.int64)), f, c, lo, hi) for lo, c, hi in substring_dedup.compact_windows(h, 10)]
        rows.sort(key=lambda r: r[2] * 4 + r[1])
        parts = substring_dedup.near_windows(tuple(np.array(c) for c in zip(*rows, strict=True)), 10)
        got = {(min(p), max(p)) for one, other in parts for p in zip(one.tolist(), other.tolist(), strict=True)}
        want = {
            (i, j) for i, (_, f, c, lo, hi) in enumerate(rows) for j, (_, g, d, low, high) in enumerate(rows)
            if i < j and f != g and low <= c <= high and lo <= d <= hi and min(hi, high) - max(lo, low) + 1 >= 10
        }
        assert got == want and want


def test_open_pairs_are_found_on_both_ways(spark, monkeypatch):
    """Small and crowded groups name the same texts, and few shingles are written for small ones."""
    rng = np.random.default_rng(8)
    frequent = [f"f{j}" for j in range(60)]
    rows = []
    for i in range(24):  # a passage that all have, and one that pairs of texts have beside it
        pair = [f"p{i // 2}w{j}" for j in range(120)]
        rows.append((i, " ".join([f"a{i}x{j}" for j in range(int(rng.integers(5, 30)))] + frequent[: 30 + i % 3] + pair)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    written = []
    kept = substring_dedup.window_shingles

    def counted(*given):
        made = kept(*given)
        written.append(made.count())
        return made

    monkeypatch.setattr(substring_dedup, "window_shingles", counted)
    columns = ["doc_id", "start_word", "end_word", "n_words", "class_id", "n_links"]
    small = substring_dedup.repeated_passages(docs).select(*columns).collect()
    monkeypatch.setattr(substring_dedup, "CROWD", 2)
    crowded = substring_dedup.repeated_passages(docs).select(*columns).collect()
    assert sorted(small) == sorted(crowded) and {r.doc_id for r in small} == set(range(24))
    assert written[0] == 0 and written[1] > 0


def test_passages_are_found_part_by_part_and_little_is_left_on_disk(spark, monkeypatch):
    """Texts sent in many parts give the same rows; tables that are read for the last time and shuffles are deleted."""
    rng = np.random.default_rng(9)
    frequent = [f"f{j}" for j in range(60)]
    texts = [" ".join([f"a{i}x{j}" for j in range(int(rng.integers(5, 30)))] + frequent[: 30 + i % 3] + [f"p{i // 3}w{j}" for j in range(120)]) for i in range(24)]
    docs = frame_of(spark, texts)
    folder, freed, parts = Path(spark.conf.get("spark.checkpoint.dir")), [], []
    stored = substring_dedup.stored

    def noted(frame, name, **rest):
        freed.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        parts.append(name)
        return stored(frame, name, **rest)

    monkeypatch.setattr(substring_dedup, "stored", noted)
    monkeypatch.setattr(links, "stored", noted)
    for crowd in (256, 2):
        monkeypatch.setattr(substring_dedup, "CROWD", crowd)
        earlier = {p.name for p in folder.iterdir()}
        whole = sorted(substring_dedup.repeated_passages(docs).collect())
        left = {p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p.name not in earlier}
        assert not left & {"groups", "text-windows", "passage-texts", "placed-windows", "window-shingles"}
        assert set(freed) == {"true"} and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
        parts.clear()
        with monkeypatch.context() as many:
            many.setattr(substring_dedup, "slices_of", lambda *_: 3)
            many.setattr(substring_dedup, "SHINGLE_BYTES", substring_dedup.LEAST_PART // 1000)
            assert sorted(substring_dedup.repeated_passages(docs).collect()) == whole and len(whole) >= 24
        assert parts.count("compared") >= 6 and (crowd == 256 or parts.count("rare-window-shingles") > 1)
