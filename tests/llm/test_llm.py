"""The training-data operators against brute force, round trips and held-out accuracy, and their edge cases."""

from __future__ import annotations

import zlib
from collections import defaultdict
from math import comb

import numpy as np
import pytest

from pyspark.sql import functions as F

from martloom.llm import (
    decontamination,
    exact_dedup,
    html_text,
    language_id,
    language_model,
    near_dedup,
    packing,
    queries,
    substring_dedup,
    token_counts,
    toxicity,
)
from martloom.llm.common import mix, shingle_table, word_table

FOLDER = "/root/testdata/sf0.001"
EDGES = "doc_id long, text string, lang string, source string, n_chars long, key long, digest string, label int, row int"


@pytest.fixture(scope="module")
def docs(spark):
    return queries.table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls, an empty, a blank and a very long text, repeated rows, and columns with names used inside."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
    texts = [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"), (6, long), (7, long)]
    return spark.createDataFrame([(i, t, None, None, None, 1, "d", 2, 3) for i, t in texts], EDGES)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EDGES)


def plain(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


# exact dedup -----------------------------------------------------------------------------------------------------------


def test_exact_dedup_edges(edges, none):
    got = plain(exact_dedup.exact_dedup(edges), "doc_id", "keep_id", "group_size", "kept")
    assert (1, 2, 2, False) in got and (2, 2, 2, True) in got and (3, 3, 1, True) in got
    assert got.count((5, 5, 4, True)) == 2 and (4, 5, 4, False) in got and (None, 5, 4, False) in got
    assert (6, 7, 2, False) in got and len(got) == 9
    assert exact_dedup.exact_dedup(none).count() == 0


def test_directory_splits_overfull_buckets(spark, docs):
    index = exact_dedup.build_index(docs, capacity=20, depth_limit=8)
    held = index.groupBy("bucket", "depth").count().collect()
    assert len(held) > 4 and all(r["count"] <= 20 or r.depth == 8 for r in held)
    assert len({r.bucket for r in held}) == len(held)


def test_directory_covers_every_slot_once(spark):
    """16 slots with 1 key each but for slot 5 with 40: only the prefixes of slot 5 are split, to the limit."""
    def key(slot, i):
        return (slot << 60 | i) - (1 << 64 if slot > 7 else 0)

    rows = [(key(s, i),) for s in range(16) for i in range(40 if s == 5 else 1)]
    found = exact_dedup.directory(spark.createDataFrame(rows, "key long"), capacity=10, depth_limit=4).collect()
    assert sorted(r.slot for r in found) == list(range(16))
    got = {r.slot: (r.depth, r.bucket) for r in found}
    want = {5: (4, 5), 4: (4, 4), 6: (3, 6), 7: (3, 6)} | {s: (2, 0) for s in range(4)} | {s: (1, 8) for s in range(8, 16)}
    assert got == want


def test_texts_that_share_a_key_are_chained(edges, docs):
    """A key that collides for all texts of one length: the whole result stays that of 64-bit hashes."""
    def poor(norm):
        return F.length(norm).cast("long")

    for rows in (edges, docs):
        index = exact_dedup.build_index(rows, 4, 6, poor)
        got = plain(exact_dedup.look_up(exact_dedup.digests(rows, poor), index, 6), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert got == plain(exact_dedup.exact_dedup(rows), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert index.where("size(chain) > 1").count() > 0


# packing ---------------------------------------------------------------------------------------------------------------


def check_pieces(pieces, texts, vocabulary):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary)
    own.encode_special_tokens = True
    ids = {d: own.encode(t or "", add_special_tokens=False).ids + [0] for d, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces.collect():
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for d, parts in by_doc.items():
        assert [a for a, _ in sorted(parts)] == list(np.cumsum([0, *(n for _, n in sorted(parts))])[:-1])
        assert sum(n for _, n in parts) == len(ids[d])
    for parts in by_sequence.values():
        parts.sort()
        assert [a for a, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1]) and sum(parts[-1]) <= 1024
    assert set(by_doc) == set(ids) and set(by_sequence) == set(range(len(by_sequence)))
    return sum(map(len, ids.values())) / 1024 / len(by_sequence)


def test_packing_round_trip(spark, docs, none):
    vocabulary = queries.vocabulary("byte_bpe_50k.json")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} | {-1: None, -2: "a  b\t\n c", -3: "<|endoftext|>"}
    extra = spark.createDataFrame([(k, texts[k]) for k in (-1, -2, -3)], "doc_id long, text string")
    fill = check_pieces(packing.pack_documents(docs.select("doc_id", "text").union(extra), vocabulary), texts, vocabulary)
    assert fill > 0.97
    assert packing.pack_documents(none, vocabulary).count() == 0


def test_query_gives_literal_added_tokens_their_id(spark, tmp_path):
    from tokenizers import Tokenizer

    vocabulary = queries.vocabulary("byte_bpe_50k.json")
    own = Tokenizer.from_file(vocabulary)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endoftext| >", "plain text"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.ids_crc32, r.doc_tokens) for r in queries.op6_packing(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert got[i] == (zlib.crc32(ids.tobytes()), len(ids))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_patterns_hold_every_piece(seed):
    dice = np.random.default_rng(seed)
    sizes = np.unique(dice.integers(1, 256, 90))
    demand = dice.integers(1, 400, len(sizes))
    plan = packing.solve_patterns(sizes, demand, 256)
    assert (sum(p * n for p, n in plan) == demand).all() and all(p @ sizes <= 256 for p, _ in plan)
    columns, used, bound = packing.solve_program(sizes, demand, 256)
    assert np.allclose(columns @ used, demand) and used.sum() <= 1.01 * bound
    assert sum(n for _, n in plan) <= used.sum() + len(sizes)


# token counts ----------------------------------------------------------------------------------------------------------


def test_token_counts_equal_greedy_longest_match(docs, edges, none):
    vocabulary = queries.vocabulary("word_bpe_49k.json")
    pieces = set(token_counts.pieces_of(vocabulary))
    longest = max(map(len, pieces))

    def greedy(word):
        symbols, n, at = (*word, token_counts.END), 0, 0
        while at < len(symbols):
            size = next(k for k in range(min(longest, len(symbols) - at), 0, -1) if symbols[at : at + k] in pieces or k == 1)
            n, at = n + 1, at + size
        return n

    few = docs.limit(40)
    want = {r.doc_id: sum(map(greedy, r.text.encode().lower().split())) for r in few.collect()}
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, vocabulary).collect()}
    assert all(got[d] == n for d, n in want.items())
    assert (1, 0, 0) in plain(token_counts.token_counts(edges, vocabulary), "doc_id", "n_words", "n_tokens")
    assert token_counts.token_counts(none, vocabulary).count() == 0


# language model --------------------------------------------------------------------------------------------------------


def test_base_score_and_counts_equal_brute_force(docs):
    rows = [(r.doc_id, language_model.tokens_of(r.text or "")) for r in docs.collect()]
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    counts = defaultdict(int)
    for d, tokens in rows:
        for w in tokens if not held[d] else []:
            counts[w] += 1
    total, words = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in language_model.score_corpus(docs).collect()}
    better = 0
    for d, tokens in rows:
        want = sum(np.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (words + 1))) for w in tokens)
        assert got[d].held_out == held[d] and got[d].train_tokens == total and got[d].n_tokens == len(tokens)
        assert got[d].n_known == sum(w in counts for w in tokens) and got[d].base_score == pytest.approx(want, rel=1e-9)
        better += held[d] and got[d].score > got[d].base_score
    assert better > 0.7 * sum(held.values())


def test_scores_of_edges(spark, edges, none):
    """Null and repeated rows, a very long text and columns with clashing names; an empty table."""
    long = spark.createDataFrame([(50, "one two " * 200_000), (51, None), (51, "one two three")], "doc_id long, text string")
    clashing = long.select("*", *(F.lit(1).alias(c) for c in ("word", "n", "row", "held_out", "shard", "triple")))
    got = language_model.score_corpus(clashing).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(50, 400_001), (51, 1), (51, 4)]
    assert all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in got)
    assert language_model.score_corpus(edges).count() == edges.count()
    assert language_model.score_corpus(none).count() == 0


def test_class_triples_cover_all_training_tokens(spark, docs):
    """Counts of classes after two others against brute force; shards hold every count in full, and share heavy ones."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    words = language_model.Words([(b"the", 9), (b"of", 8), (language_model.END_TOKEN, 7)], 3)
    end, want = words.class_of(language_model.END_TOKEN), defaultdict(int)
    for r in texts.collect():
        k = [end, end, *(words.class_of(w) for w in language_model.tokens_of(r.text))]
        for a, b, c in zip(k, k[1:], k[2:]):
            want[a << 24 | b << 12 | c] += 1
    found = language_model.class_triples(texts, spark.sparkContext.broadcast(words))
    assert {r.triple: r.n for r in found.collect()} == want
    shards = language_model.deal_shards(found, shard_rows=max(1, len(want) // 4)).collect()
    dealt, masses = defaultdict(float), []
    for r in shards:
        weights = np.frombuffer(r.weights, "<f4")
        masses.append(weights.sum())
        for t, w in zip(np.frombuffer(r.triples, "<i8"), weights, strict=True):
            dealt[int(t)] += w
    assert dealt == pytest.approx(want, rel=1e-5) and len(shards) >= 4 and max(masses) < 2 * sum(masses) / len(masses)


def test_network_learns_from_every_shard(spark):
    """Each shard alone knows one follower of a class; the mean of the shards knows all of them."""
    rows = [(a << 24 | b << 12 | (b + 1) % 8, 500) for a in range(8) for b in range(8)]
    triples = spark.createDataFrame(rows, "triple long, n long")
    share = np.full(8, 1 / 8)
    network = language_model.train_on_shards(language_model.Network(8), language_model.deal_shards(triples, 16), share, rounds=20)
    hits = sum(int(((network.near[b] + network.far[a]) @ network.target.T + network.bias).argmax() == (b + 1) % 8) for a in range(8) for b in range(8))
    assert hits > 56
    once, again = (language_model.train_on_shards(language_model.Network(8), language_model.deal_shards(triples, 16), share, 1) for _ in "ab")
    assert (once.flat() == again.flat()).all()


def test_network_is_normalised():
    dice = np.random.default_rng(0)
    far, near, target = dice.integers(0, 20, (3, 5000))
    net = language_model.Network(20).train(far, near, (near + 1) % 20, epochs=20, noise=10)
    z = net.normalisers()
    logits = (net.near[3] + net.far[7]) @ net.target.T + net.bias
    assert np.exp(logits - z[7, 3]).sum() == pytest.approx(1, abs=1e-4)
    assert logits.argmax() == 4 and target.size


# toxicity and language -------------------------------------------------------------------------------------------------


def test_toxicity_finds_words_of_confirmed_texts(spark, none):
    dice = np.random.default_rng(1)
    word = lambda: "".join(dice.choice(list("aeioulnst"), 5))
    rows = [(i, " ".join(word() for _ in range(30)) + (" vileword" if i % 9 == 0 else ""), int(i % 9 == 0)) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = table.select("doc_id", "toxic").where("doc_id % 2 = 0")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(table.select("doc_id", "text"), labels).collect()}
    assert all(got[i] == bad for i, _, bad in rows)
    empty = toxicity.toxicity(table.select("doc_id", "text"), labels.limit(0))
    assert empty.where("predicted = 1").count() == 0 and toxicity.toxicity(none, labels).count() == 0


def test_languages_of_held_out_texts(docs, edges, none):
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    named = {r.doc_id: r.lang_pred for r in language_id.predict_languages(edges, language_id.fit(docs)).collect()}
    assert named[1] == named[2] == named[3] == "und" and named[4] != "und"
    assert language_id.language_id(none).count() == 0 and {r.lang_pred for r in language_id.language_id(edges).collect()} == {"und"}


# pages -----------------------------------------------------------------------------------------------------------------


def test_article_without_boilerplate(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav>
      <div class="cookie-notice">We use cookies, as ever.</div><article><h1>A  title</h1><p>First &amp; best, here.<p>Second
      <b>one</b>, longer.<script>var x='</p>';</script></p></article><section class="comments"><p>Nice one, thanks!</p></section>
      <form><p>Your name, please.</p></form><footer>&copy; us</footer></body></html>"""
    assert html_text.main_text(page) == "A title\nFirst & best, here.\nSecond one, longer."
    rows = [(1, "u", page, 5), (2, None, None, 5), (None, "u", "", 5), (4, "u", "<p>cut off, yes <b", 5)]
    got = plain(html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text int")), "page_id", "n_chars")
    assert (2, 0) in got and (None, 0) in got and (4, 12) in got and len(got) == 4


def test_short_links_and_wrappers_stay_in_the_article():
    words = "The city council met again on Monday, and the members talked about roads, schools and water for hours. "
    linked = f"{words * 2}Most of them had come from <a href=/p>Paris</a> by train. {words}"
    page = "<html><body><article>" + f"<p>{linked}</p>" * 4 + "</article></body></html>"
    assert html_text.main_text(page).count("from Paris by train") == 4
    for name in ("content has-sidebar", "with-sidebar", "page-header-layout", "widget"):
        wrapped = f"<html><body><div class='{name}'>" + f"<p>{words * 3}</p>" * 4 + "</div><div class='sidebar'>Top, news.</div></body></html>"
        assert html_text.main_text(wrapped).count("council") == 12 and "Top" not in html_text.main_text(wrapped)
    assert html_text.main_text(page.replace("</article>", "<div class='comments'><p>Nice one, thanks!</p></div></article>")) == html_text.main_text(page)


def test_names_and_forms_around_prose():
    """What names say: reader comments go under any name, prose under a name that only hints at boilerplate stays."""
    words = "The city council met again on Monday, and the members talked about roads, schools and water for hours. "
    prose = f"<h1>Head line</h1>{f'<p>{words * 3}</p>' * 4}"
    page = lambda body: html_text.main_text(f"<html><body>{body}</body></html>")
    want = page(f"<article>{prose}</article>")
    assert want.startswith("Head line\nThe city") and want.count("council") == 12
    assert page(f"<form id=all action=/><nav>Home</nav><article>{prose}</article></form>") == want
    assert page(f"<form id=all><div class=menu>Home, shop.</div><div class=content>{prose}</div><input name=q></form>") == want
    headed = prose.replace("<h1>Head line</h1>", "<div class='article-header'><h1>Head line</h1></div>")
    assert page(f"<article>{headed}</article>") == want
    assert page(f"<article>{prose}<section class='related-work'><p>{words * 3}</p></section></article>").count("council") == 15
    assert page(f"<article>{prose}<p id='notice-period'>{words * 2}</p></article>").count("council") == 14
    assert page(f"<article>{prose}<div class='related-links'><p>See, too.</p></div></article>") == want
    for name in ("user-reviews", "discussion", "comment-list", "commentsSection", "replies"):
        assert page(f"<article>{prose}<div class='{name}'><p>Nice one, {words}</p></div></article>") == want
        assert page(f"<div class=content>{prose}<div id='{name}'><p>Nice one, {words}</p></div></div>") == want
    assert page(f"<article>{prose}</article><article><h2>Second</h2><p>{words * 9}</p></article>").startswith(want + "\nSecond\nThe city")
    assert page(f"<article>{prose}<p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>") == want + "\nHere x=2 holds."


def test_deep_long_and_missing_pages(spark):
    deep = "<div>" * 6000 + "<p>hello there, you.</p>" * 6000
    assert html_text.main_text(deep).count("hello there, you.") == 6000
    long = "<article>" + "<p>One sentence, and another one.</p>" * 40_000 + "</article>"
    schema = "page_id long, url string, html string, text string, n_chars int, block int"
    rows = [(1, "u", long, "x", 0, 0), (1, "u", long, "x", 0, 0), (None, None, "<p>Short, but here.", None, None, None)]
    got = plain(html_text.extract_pages(spark.createDataFrame(rows, schema)), "page_id", "n_chars")
    size = 40_000 * len("One sentence, and another one.") + 39_999
    assert sorted(got, key=str) == [(1, size), (1, size), (None, 16)]
    assert html_text.extract_pages(spark.createDataFrame([], schema)).columns == ["page_id", "url", "text", "n_chars"]
    assert html_text.extract_pages(spark.createDataFrame([], schema)).count() == 0


# benchmark -------------------------------------------------------------------------------------------------------------


def test_leaks_with_and_without_edits(spark, edges):
    dice = np.random.default_rng(4)
    letters = list("abcdefghij ")
    text = lambda n: "".join(dice.choice(letters, n))
    items = [(i, text(120)) for i in range(30)]
    rows, want = [], set()
    for i, item in items:
        edited = list(item)
        for p in dice.choice(120, 8, replace=False):
            edited[p] = "z"
        rows.append((i, text(300) + "".join(edited) + text(200)))
        rows.append((100 + i, text(600)))
        want.add((i, i))
    bench = spark.createDataFrame([*items, (98, None), (99, " ")], "item_id long, text string")
    got = decontamination.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench, block_chars=1000)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert decontamination.find_leaks(edges, bench.limit(0)).count() == 0
    assert decontamination.clean_documents(edges, bench).columns == edges.columns


def test_recall_at_the_edit_limit(spark):
    """Items with exactly the allowed number of inserted, deleted and replaced characters."""
    dice = np.random.default_rng(21)
    letters = list("abcdefghijklmnop ")
    text = lambda n: "".join(dice.choice(letters, n)).strip()
    rows, items = [], []
    for i in range(240):
        item = decontamination.normal(text(int(dice.integers(60, 200))))
        edited = list(item)
        for p in sorted(dice.choice(len(item), decontamination.edits_allowed(len(item), 0.1), replace=False), reverse=True):
            kind = dice.integers(3)
            edited[p : p + (kind != 0)] = [] if kind == 1 else ["z"]
        items.append((i, item))
        rows.append((i, f"{text(200)} {''.join(edited)} {text(150)}"))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id int, text string"))
    assert dict(got.dtypes)["item_id"] == "int" and dict(got.dtypes)["doc_id"] == "int"
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert len(pairs) >= 0.95 * len(items) and all(d == n for d, n in pairs)


def test_long_items_beside_short_ones(spark):
    dice = np.random.default_rng(22)
    long = decontamination.normal("".join(dice.choice(list("abcdefghij "), 30_000)))
    items = [("long", long), ("short", "one two three four five six"), (None, "seven eight nine ten eleven")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id string, text string, doc_id int")
    rows = [("a", f"before {long[:9000]}Z{long[9001:]} after"), ("b", "x one two three four five six y"), (None, "seven eight nine ten eleven")]
    docs = spark.createDataFrame([(*r, "?", 1) for r in rows], "doc_id string, text string, item_id string, distance int")
    got = plain(decontamination.find_leaks(docs, bench), "doc_id", "item_id", "distance")
    assert sorted(got, key=str) == sorted([("a", "long", 1), ("b", "short", 0), (None, None, 0)], key=str)


def test_closest_is_the_edit_distance():
    def slow(item, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    dice = np.random.default_rng(2)
    for _ in range(60):
        a, b = ("".join(dice.choice(list("abc"), n)) for n in dice.integers(1, 40, 2))
        assert decontamination.closest(a, b)[0] == slow(a, b)


# near and substring dedup ----------------------------------------------------------------------------------------------


def grams(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_duplicates_against_all_pairs(spark, docs, edges, none):
    rows = [(r.doc_id, grams(r.text)) for r in docs.collect()]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert set(got) == {d for d, _ in rows}
    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            share = len(x & y) / len(x | y)
            assert share < 0.86 or got[a] == got[b]
            assert share > 0 or got[a] != got[b]
    held = plain(near_dedup.near_duplicates(edges), "doc_id", "class_id", "class_size", "kept")
    assert (4, 4, 4, True) in held and (None, 4, 4, False) in held and (6, 6, 2, True) in held and (1, 1, 2, True) in held
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_against_all_pairs_by_weight(spark):
    """Edited copies around the threshold, by the operator's own measure: enough links, and none below 0.8."""
    rng = np.random.default_rng(12)
    texts = []
    for k in range(30):
        base = [f"w{rng.integers(400)}" for _ in range(150)]
        texts += [" ".join(w if rng.random() > 0.007 * i else f"x{rng.integers(90)}" for w in base) for i in range(8)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame).collect()}
    weigh = near_dedup.Weigher(near_dedup.inverse_frequencies(frame))
    weighed = [weigh(t) for t in texts]
    linked, near, found = {i: i for i in got}, 0, 0

    def root(i):
        while linked[i] != i:
            i = linked[i]
        return i

    for i, x in enumerate(weighed):
        for j, y in enumerate(weighed[:i]):
            if near_dedup.weighted_jaccard(x, y) >= 0.8:
                near += 1
                found += got[i] == got[j]
                linked[root(i)] = root(j)
    assert near > 100 and found >= 0.97 * near
    assert all(root(i) == root(c) for i, c in got.items())


def test_common_weight_bounds_what_texts_share(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(w if rng.random() > 0.005 * i else f"x{i}y{j}" for j, w in enumerate(base)) for i in range(6)] + ["apart", "one two"]
    idf = spark.sparkContext.broadcast(np.ones(near_dedup.CELLS, np.float32))
    frame = spark.createDataFrame([(str(i).encode(), t) for i, t in enumerate(texts)], "digest binary, text string")
    common = {int(bytes(r.digest)): r.common for r in near_dedup.rare_shingles(frame, idf, 0.5).collect()}
    weighed = [dict(zip(*near_dedup.Weigher(idf.value)(t), strict=True)) for t in texts]
    for i, mine in enumerate(weighed):
        held = sum(v for k, v in mine.items() if any(k in w for j, w in enumerate(weighed) if j != i)) / sum(mine.values())
        assert common.get(i, 0) == pytest.approx(held) if held >= 0.5 else i not in common
    assert len(common) > 3


def test_labels_meet_on_shingles_before_their_texts_do(spark):
    rng = np.random.default_rng(3)
    rows = [(int(s), str(d).encode(), bool(rng.random() < 0.6), str(d % 4).encode(), 100.0 + d) for d in range(24) for s in rng.choice(30, 5, replace=False)]
    entries = spark.createDataFrame(rows, "shingle long, digest binary, short boolean, label binary, weight double")
    got = sorted((bytes(r.x), bytes(r.y)) for r in near_dedup.sharing_pairs(entries, 0.8).collect())
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[2] and a[3] != b[3] and a[4] < b[4] and a[4] >= 0.8 * 0.9999 * b[4]}
    assert got == sorted(want) and len(want) > 20


def test_pairs_that_cannot_be_links_leave_the_join(spark):
    """Packed samples agree as often as their bytes, and a pair of too few is not given."""
    dice = np.random.default_rng(4)
    bytes_ = dice.integers(0, 256, (30, near_dedup.BANDS * near_dedup.ROWS), dtype=np.uint8)
    for i in range(1, 30):  # each text agrees with the first in about 2 i samples
        bytes_[i, : 2 * i] = bytes_[0, : 2 * i]
    packed = [np.pad(b, (0, -len(b) % 8)).view(np.int64).tolist() for b in bytes_]
    rows = [(1, str(100 + i).encode(), True, i, 1.0 + i / 1000, (1.0 + i / 1000, packed[i], [7], 2.0)) for i in range(30)]
    facts = "struct<weight: double, samples: array<long>, buckets: array<long>, common: double>"
    entries = spark.createDataFrame(rows, f"shingle long, digest binary, short boolean, label int, weight double, facts {facts}")
    got = {(int(r.x) - 100, int(r.y) - 100) for r in near_dedup.sharing_pairs(entries, 0.8, near_dedup.likely).collect()}
    agree = {(i, j): int((bytes_[i] == bytes_[j]).sum()) for i in range(30) for j in range(i + 1, 30)}
    assert got == {p for p, n in agree.items() if n >= near_dedup.CLOSE_SAMPLES} and 0 < len(got) < len(agree)


def test_similar_texts_share_a_rare_shingle(spark):
    rng, base = np.random.default_rng(8), [f"w{i}" for i in range(200)]
    edits = [" ".join(w if rng.random() > 0.004 * (i % 8) else f"x{rng.integers(2)}" for w in base) for i in range(24)]
    texts = edits + [t + " tail end" for t in edits[:6]] + ["one two", "apart from all the others"]
    idf = spark.sparkContext.broadcast(np.ones(near_dedup.CELLS, np.float32))
    frame = spark.createDataFrame([(str(i).encode(), t) for i, t in enumerate(texts)], "digest binary, text string")
    rare, short = defaultdict(set), defaultdict(set)
    for r in near_dedup.rare_shingles(frame, idf, 0.8).collect():
        rare[int(bytes(r.digest))].add(r.shingle)
        if r.short:
            short[int(bytes(r.digest))].add(r.shingle)
    weighed = [near_dedup.Weigher(idf.value)(t) for t in texts]
    near = 0
    for i, x in enumerate(weighed):
        for j, y in enumerate(weighed):
            if i != j and x[1].sum() <= y[1].sum() and near_dedup.weighted_jaccard(x, y) >= 0.8:
                near += 1
                assert short[i] & rare[j]
    assert near > 30

def test_samples_agree_as_often_as_texts_are_similar():
    dice, sample = np.random.default_rng(3), near_dedup.Sampler(2000)
    keys, weights = np.sort(dice.integers(0, 1 << 63, 300, dtype=np.uint64)), dice.uniform(1, 9, 300).astype(np.float32)
    a, b = (keys[:220], weights[:220]), (keys[60:], weights[60:])
    assert (sample(*a) == sample(*b)).mean() == pytest.approx(near_dedup.weighted_jaccard(a, b), abs=0.05)


def test_compact_windows_cover_every_stretch_once():
    dice = np.random.default_rng(5)
    for size in (7, 30, 60):
        x = dice.integers(0, 15, size).astype(np.uint64)
        found = substring_dedup.compact_windows(x, 7)
        for a in range(size):
            for b in range(a + 6, size):
                own = [c for low, c, high in found if low <= a and b <= high and a <= c <= b]
                assert own == [a + int(x[a : b + 1].argmin())]


def test_repeated_passages_against_brute_force(docs, edges, none):
    seen = defaultdict(set)
    for r in docs.collect():
        words = r.text.lower().split()
        for i in range(len(words) - 49):
            seen[tuple(words[i : i + 50])].add(r.doc_id)
    want = set().union(*(s for s in seen.values() if len(s) > 1))
    got = substring_dedup.repeated_passages(docs).collect()
    assert want <= {r.doc_id for r in got} and all(r.n_words >= 50 for r in got)
    assert {r.doc_id for r in substring_dedup.repeated_passages(edges).collect()} == {6, 7}
    assert substring_dedup.repeated_passages(none).count() == 0


def test_passages_hidden_from_the_ends_of_a_group(spark):
    fresh = (f"z{i}" for i in range(1_000_000))
    take = lambda n: [next(fresh) for _ in range(n)]
    lines, sets = [take(16) for _ in range(12)], []
    rows = [(i, " ".join([*take(40), *lines[i % 12], *take(40)])) for i in range(120)]
    dice = np.random.default_rng(12)
    while len(sets) < 20:
        own = dice.choice(12, 4, replace=False).tolist()
        if all(len(set(own) & set(x)) <= 2 for x in sets):
            sets.append(own)
    wanted = {}
    for i, own in enumerate(sets):  # two texts share a passage of frequent lines
        passage = [w for x in own for w in lines[x]]
        for j, k in ((200 + 2 * i, 201 + 2 * i), (201 + 2 * i, 200 + 2 * i)):
            rows.append((j, " ".join([*take(40), *passage, *take(40)])))
            wanted[j] = k
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.partner_id for r in found} == wanted and {r.n_links for r in found} == {1}
    assert len({r.class_id for r in found}) == len(sets)


def test_every_occurrence_of_a_passage_is_reported(spark):
    fresh = (f"z{i}" for i in range(1_000_000))
    take = lambda n: [next(fresh) for _ in range(n)]
    rows = []
    for i in range(12):
        passage = take(80)
        rows += [(2 * i, " ".join([*passage, *take(60), *passage])), (2 * i + 1, " ".join([*take(9), *passage, *take(9)]))]
    found = plain(substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "start_word", "end_word")
    assert found == sorted([x for i in range(12) for x in ((2 * i, 0, 80), (2 * i, 140, 220), (2 * i + 1, 9, 89))], key=repr)


def test_recall_of_passages_at_the_threshold():
    chance = substring_dedup.SIMILARITY
    n, enough = substring_dedup.FUNCTIONS, substring_dedup.ENOUGH
    assert sum(comb(n, k) * chance**k * (1 - chance) ** (n - k) for k in range(enough, n + 1)) > 0.97
    dice, met = np.random.default_rng(21), 0
    for _ in range(400):  # shingles of which 8 of 10 in the union are common to both passages
        x = dice.integers(1, 1 << 63, 90, dtype=np.uint64)
        y = np.r_[x[:80], dice.integers(1, 1 << 63, 10, dtype=np.uint64)]
        met += sum(mix(x, 100 + f).min() == mix(y, 100 + f).min() for f in range(n)) >= enough
    assert met / 400 > 0.95


def test_word_tables_equal_words_of_single_texts():
    texts = ["", " a b", "A  b\n", "x" * 700 + " y", "\t"]
    ids, bounds = word_table(texts)
    assert np.diff(bounds).tolist() == [0, 2, 2, 2, 0] and (ids[0:2] == ids[2:4]).all()
    assert np.diff(shingle_table(texts, 2)[1]).tolist() == [0, 1, 1, 1, 0]


# pipeline --------------------------------------------------------------------------------------------------------------


def test_pipeline_keeps_columns_and_drops_in_order(spark, docs):
    import corpus_pipeline

    now = docs
    for name, stage in corpus_pipeline.STAGES[:2]:
        later = stage(spark, now, FOLDER)
        assert later.columns == docs.columns and later.select("doc_id").subtract(now.select("doc_id")).count() == 0
        now = later
    texts = [r.text.lower() for r in now.collect()]
    assert len(set(texts)) == len(texts)
    assert corpus_pipeline.run(spark, FOLDER).columns[:2] == ["doc_id", "start"]


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    import corpus_pipeline

    long = "the quick brown fox jumps over a lazy dog while many other animals look on and wonder about it all day"
    rows = [(5, "Same text"), (5, "other clean text"), (9, "same text"), (7, "dup"), (7, "dup"), (None, "dup"), (None, None), (None, "")]
    rows += [(1, long + " x"), (1, long + " y"), (1, "clean and short"), (None, long)]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, lang string, row string")
    kept = corpus_pipeline.drop_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    once = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert [r for r in once if r[1]] == sorted([(5, "other clean text"), (7, "dup"), (9, "same text"), *rows[8:]], key=repr)
    assert len(once) == 8
    kept.write.parquet(str(tmp_path / "kept"))
    near = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "kept")), FOLDER)
    left = [(r.doc_id, r.text) for r in near.collect()]
    assert sum(bool(t) and t.startswith(long) for _, t in left) == 1 and (1, "clean and short") in left and len(left) == 6


def test_pipeline_drops_toxic_and_leaked_rows_without_an_id(spark):
    import corpus_pipeline

    folder = FOLDER.replace("sf0.001", "sf0.1")
    docs, labels = queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels").where("toxic = 1")
    toxic = docs.join(labels, "doc_id").select(*docs.columns).orderBy("doc_id").limit(5)
    item = queries.table(spark, folder, "benchmark").where("length(text) > 60").first().text
    leak = spark.createDataFrame([(None, f"before {item} after", "en", None, 1), (3, "clean words", "en", None, 1), (3, item, "en", None, 1)], docs.schema)
    nameless = toxic.withColumn("doc_id", F.lit(None).cast("long")).unionByName(leak)
    clean = corpus_pipeline.drop_leaks(spark, nameless, folder)
    assert [r.doc_id for r in clean.where("source is null").collect()] == [3]
    whole = docs.unionByName(nameless)
    left = corpus_pipeline.drop_toxic(spark, whole, folder)
    gone = {r.text for r in toxic.collect()} - {r.text for r in left.collect()}
    assert len(gone) >= 4 and left.where("text = 'clean words'").count() == 1


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    from martloom.llm import common

    class Context:
        master = "spark://host:7077"

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_folder(Session)
