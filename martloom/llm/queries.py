"""The operators' queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import (
    decontamination,
    exact_dedup,
    html_text,
    language_id,
    language_model,
    license_scan,
    merkle_manifest,
    near_dedup,
    packing,
    spelling_variants,
    substring_dedup,
    token_counts,
    toxicity,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The installed vocabulary file of that name."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents"))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_corpus(table(spark, folder, "documents"))


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_pages(table(spark, folder, "pages"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), added_tokens=True)


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_id(table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.verify_tampered(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name; each takes the session and a folder of tables."""
    found = (
        op1_substring_dedup,
        op2_lm_scoring,
        op3_html_text,
        op4_exact_dedup,
        op5_toxicity,
        op6_packing,
        op7_language_id,
        op8_token_counts,
        op9_decontamination,
        op10_near_dedup,
        op11_license_scan,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
    return {f.__name__: f for f in found}


def _license_sql() -> str:
    every = [*license_scan.PHRASES, *license_scan.NOTICES]
    templates = ", ".join(
        f"({i}, {i < len(license_scan.PHRASES)}, '{t.label}', {t.run}, '{t.text}')" for i, t in enumerate(every)
    )
    return LICENSE_SQL.format(templates=templates, least=license_scan.SIMILARITY)


LICENSE_SQL = """
WITH templates AS (
    SELECT * FROM (VALUES {templates}) AS t(template, base, label, k, text)
),
pieces AS (
    SELECT template, base, label, k, w, length(w) - k + 1 AS grams, unnest(range(0, length(w) - k + 1)) AS spot
    FROM (SELECT *, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM templates)
),
wanted AS (
    SELECT template, base, label, k, grams, spot, array_to_string(w[spot + 1:spot + k], ' ') AS run FROM pieces
),
texts AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
),
places AS (SELECT rid, w, unnest(range(0, length(w))) AS place FROM texts),
sizes AS (SELECT DISTINCT k FROM templates),
runs AS (
    SELECT rid, place, k, array_to_string(w[place + 1:place + k], ' ') AS run
    FROM places, sizes WHERE place + k <= length(w)
),
votes AS (
    SELECT rid, template, base, label, k, grams, place - spot AS diagonal, spot
    FROM runs JOIN wanted USING (k, run)
),
diagonals AS (
    SELECT rid, template, base, label, k, grams, diagonal, list(DISTINCT spot) AS spot FROM votes GROUP BY ALL
),
marked AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER line <= floor((grams + k - 1) * (1 - {least}) + 1e-9) THEN 0 ELSE 1 END AS fresh
    FROM diagonals WINDOW line AS (PARTITION BY rid, template ORDER BY diagonal)
),
grouped AS (
    SELECT *, sum(fresh) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM marked
),
merged AS (
    SELECT rid, template, base, label, k, grams, span, min(diagonal + list_min(spot)) AS first,
           max(diagonal + list_max(spot) + k) AS last, length(list_distinct(flatten(list(spot)))) AS votes
    FROM grouped GROUP BY ALL
),
spans AS (
    SELECT *, least(votes, last - first - k + 1) AS shared, last - first - k + 1 AS own FROM merged
),
verified AS (
    SELECT *, shared / (grams + own - shared) AS similarity FROM spans WHERE shared / (grams + own - shared) >= {least}
),
found AS (
    SELECT rid, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(similarity) AS score
    FROM verified GROUP BY rid
)
SELECT doc_id, length(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN found ON found.rid = texts.rid
"""

VARIANTS_SQL = """
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-zÀ-ÿ]+')) AS run
    FROM documents
),
counted AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run AS named, run, count(*) AS times
    FROM runs WHERE length(run) >= 5 GROUP BY ALL
),
hashed AS (
    SELECT run, times,
           xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
               regexp_extract_all(hex(encode(named)), '..'),
               lambda c: [('0x' || c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
               4294967295::BIGINT) AS h
    FROM counted
),
words AS (
    SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word,
           CAST(sum(times) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING sum(times) >= 3 AND length(word) >= 5
),
cuts AS (
    SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
),
best AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word
),
found AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
           CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
),
walk AS (
    SELECT word, word AS at FROM found
    UNION ALL
    SELECT w.word, f.form FROM walk w JOIN found f ON f.word = w.at WHERE f.form IS NOT NULL
),
roots AS (
    SELECT w.word, w.at AS root FROM walk w JOIN found f ON f.word = w.at WHERE f.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM found f JOIN roots r ON r.word = f.word
"""

MANIFEST_SQL = """
WITH RECURSIVE named AS (
    SELECT doc_id, coalesce('=' || source, '') AS grp, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)] AS head, text,
           list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
               string_split(coalesce(CAST(doc_id AS VARCHAR), 'null'), ''),
               lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
               & 1 = 1 AS even_crc
    FROM documents
),
framed AS (
    SELECT doc_id, grp, array_to_string(list_transform(head,
               lambda x: CASE WHEN x IS NULL THEN '-' ELSE CAST(strlen(x) AS VARCHAR) || ':' || x END), '') AS front,
           text, CASE WHEN even_crc THEN replace(text, chr(10), '') ELSE text END AS now
    FROM named
),
leaves AS (
    SELECT doc_id, grp, sha256(front || CASE WHEN text IS NULL THEN '-' ELSE CAST(strlen(text) AS VARCHAR) || ':' || text END) AS leaf,
           sha256(front || CASE WHEN now IS NULL THEN '-' ELSE CAST(strlen(now) AS VARCHAR) || ':' || now END) AS now
    FROM framed
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves
),
lower_tree AS (
    SELECT grp, 0 AS level, rank, leaf AS digest FROM ranked
    UNION ALL
    SELECT grp, level + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank))
    FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS nodes FROM lower_tree)
    WHERE nodes > 1 GROUP BY grp, level, rank // 3
),
subroots AS (
    SELECT grp, arg_max(digest, level) AS subroot, max(level) AS height,
           row_number() OVER (ORDER BY grp) - 1 AS place
    FROM lower_tree GROUP BY grp
),
upper_tree AS (
    SELECT 0 AS level, place AS rank, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank))
    FROM (SELECT *, count(*) OVER () AS nodes FROM upper_tree)
    WHERE nodes > 1 GROUP BY level, rank // 3
),
top AS (SELECT max(level) AS height, arg_max(digest, level) AS root FROM upper_tree),
lower_steps AS (
    SELECT r.doc_id, r.grp, r.rank, t.level,
           coalesce(string_agg(t.digest, '' ORDER BY t.rank) FILTER (t.rank < r.rank // CAST(pow(3, t.level) AS BIGINT)), '') AS l,
           coalesce(string_agg(t.digest, '' ORDER BY t.rank) FILTER (t.rank > r.rank // CAST(pow(3, t.level) AS BIGINT)), '') AS r
    FROM ranked r JOIN subroots s ON r.grp = s.grp
    JOIN lower_tree t ON t.grp = r.grp AND t.level < s.height
        AND t.rank // 3 = r.rank // CAST(pow(3, t.level + 1) AS BIGINT)
    GROUP BY r.doc_id, r.grp, r.rank, t.level
),
upper_steps AS (
    SELECT s.grp, t.level,
           coalesce(string_agg(t.digest, '' ORDER BY t.rank) FILTER (t.rank < s.place // CAST(pow(3, t.level) AS BIGINT)), '') AS l,
           coalesce(string_agg(t.digest, '' ORDER BY t.rank) FILTER (t.rank > s.place // CAST(pow(3, t.level) AS BIGINT)), '') AS r
    FROM subroots s, top p, upper_tree t
    WHERE t.level < p.height AND t.rank // 3 = s.place // CAST(pow(3, t.level + 1) AS BIGINT)
    GROUP BY s.grp, t.level
),
low AS (SELECT grp, rank, list(l || '|' || r ORDER BY level) AS steps FROM lower_steps GROUP BY grp, rank),
high AS (SELECT grp, list(l || '|' || r ORDER BY level) AS steps FROM upper_steps GROUP BY grp),
paths AS (
    SELECT r.*, s.subroot, p.root, list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
    FROM ranked r JOIN subroots s ON s.grp = r.grp CROSS JOIN top p
    LEFT JOIN low ON low.grp = r.grp AND low.rank = r.rank LEFT JOIN high ON high.grp = r.grp
),
checked AS (
    SELECT doc_id, leaf, subroot, root,
           sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
           list_reduce(list_prepend(now, steps),
                       lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
    FROM paths
)
SELECT *, folded_root = root AS verified FROM checked
"""


def oracles() -> dict[str, str]:
    return {
        "op4_exact_dedup": """
            WITH n AS (
                SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                         'abcdefghijklmnopqrstuvwxyz') AS norm
                FROM documents
            )
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
            FROM n WINDOW w AS (PARTITION BY norm)""",
        "op11_license_scan": _license_sql(),
        "op12_spelling_variants": VARIANTS_SQL,
        "op13_merkle_manifest": MANIFEST_SQL,
    }
