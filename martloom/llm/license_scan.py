"""License texts in documents by diagonal voting, in DataFrame operations only.

Every run of k words of every document is hashed and joined to the places of the templates' runs; equal runs are then
compared word by word. A pair of places votes for its diagonal, the document place less the template place, which is
where the whole template would begin. Diagonals that lie so close that inserted or deleted words may have parted them
are merged, and the span under the merged votes is verified: its similarity to the template is that of their runs of k
words, shared ones divided by all. A phrase of a few words has no room for edits, so it is found only as it stands.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import lower_ascii, whole_text

#: What lies between words: all ASCII but digits and letters. Cutting at these is many times faster than a search for
#: runs of all the others.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words of a run, for phrases and for longer notices; least similarity of a span.
PHRASE_RUN, NOTICE_RUN, SIMILARITY = 2, 5, 0.8
#: Templates of up to so many words in all are sent to every executor, larger ones are joined by a shuffle.
BROADCAST_WORDS = 200_000


class Template(NamedTuple):
    """A text to look for; ``run`` is the number of words hashed together, at most as many as the text has."""

    label: str
    text: str
    run: int = NOTICE_RUN


# Phrases that name a license.
PHRASES = (
    Template("mit", "mit license", PHRASE_RUN),
    Template("apache", "apache license", PHRASE_RUN),
    Template("gpl", "general public license", PHRASE_RUN),
)

# Notices of well-known licenses.
NOTICES = (
    Template("mit", "Released under the MIT License."),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
    ),
    Template("apache", "Licensed under the Apache License, Version 2.0"),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    Template(
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
    Template("cc-by", "Licensed under CC BY 4.0."),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


def words_of(text: Column) -> Column:
    """The words of a text: its longest runs of digits, letters and anything beyond ASCII."""
    return F.array_remove(F.split(text, BETWEEN), "")


def runs(texts: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``texts`` with one row for each run of each size: its first word's ``place``, ``size`` and ``hash``.

    ``texts`` has ``words``. Words are hashed once; a run is hashed from the hashes of its words.
    """
    hashed = texts.withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    # No filter on the number of words here: it would move below and find the words a second time.
    placed = hashed.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.size("_h") - 1, F.lit(0)))).alias("place"))

    def run(size: int) -> Column:
        parts = [F.get("_h", F.col("place") + i) for i in range(size)]
        return F.struct(F.lit(size).alias("size"), F.xxhash64(*parts).alias("hash"))

    sized = placed.select("*", F.explode(F.array(*[run(s) for s in sizes])).alias("_run"))
    return sized.select(*texts.columns, "place", "_run.size", "_run.hash").where(
        F.col("place") + F.col("size") <= F.size("words")
    )


def template_runs(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(template, label, grams, size, hash, at, run): the runs of all templates and where they begin."""
    rows = [
        F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.run).alias("own"), F.lit(t.text).alias("text"))
        for i, t in enumerate(templates)
    ]
    texts = spark.range(1).select(F.inline(F.array(*rows))).withColumn("words", words_of(lower_ascii(F.col("text"))))
    found = runs(texts, sorted({t.run for t in templates})).where("size = own")
    return found.select(
        "template",
        "label",
        (F.size("words") - F.col("size") + 1).alias("grams"),
        "size",
        "hash",
        F.col("place").alias("at"),
        F.slice("words", F.col("place") + 1, F.col("size")).alias("run"),
    )


def find_spans(docs: DataFrame, templates: Sequence[Template], key: Sequence[Column], similarity: float = SIMILARITY) -> DataFrame:
    """(key columns, template, label, first, words, similarity): spans of documents that match a template.

    ``first`` is the place of the span's first word, ``words`` their number. ``key`` names a document; rows with equal
    keys must have equal texts and count once. Nothing is collected per document but places within one template.
    """
    spark = docs.sparkSession
    names = [f"_k{i}" for i in range(len(key))]
    sizes = sorted({t.run for t in templates})
    texts = docs.select(*[c.alias(n) for c, n in zip(key, names, strict=True)], words_of(lower_ascii(whole_text())).alias("words"))
    wanted = template_runs(spark, templates)
    if sum(len(t.text.split()) for t in templates) <= BROADCAST_WORDS:
        wanted = F.broadcast(wanted)
    # Words are compared where hashes agree. As an equation this would be a join key, worked out for every run.
    same = F.array_contains(F.array("run"), F.slice("words", F.col("place") + 1, F.col("size")))
    votes = runs(texts, sizes).join(wanted, ["size", "hash"]).where(same)
    voted = votes.groupBy(*names, "template", "label", "grams", "size", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("at")
    )
    # As many words as an edited span may lack or have too many.
    slack = F.floor((F.col("grams") + F.col("size") - 1) * F.lit(1 - similarity) + F.lit(1e-9))
    line = Window.partitionBy(*names, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(line) > slack
    merged = (
        voted.withColumn("_new", F.coalesce(apart.cast("int"), F.lit(1)))
        .withColumn("_span", F.sum("_new").over(line))
        .groupBy(*names, "template", "label", "grams", "size", "_span")
        .agg(
            F.min(F.col("diagonal") + F.array_min("at")).alias("first"),
            F.max(F.col("diagonal") + F.array_max("at") + F.col("size")).alias("_end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("_votes"),
        )
    )
    length = F.col("_end") - F.col("first")
    own = length - F.col("size") + 1
    shared = F.least(F.col("_votes"), own)
    alike = (shared / (F.col("grams") + own - shared)).alias("similarity")
    spans = merged.select(*names, "template", "label", "first", length.alias("words"), alike)
    return spans.where(F.col("similarity") >= similarity)


def license_scan(
    docs: DataFrame, phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``base`` columns tell of the phrases' places: their number, least and greatest start (null without one) and labels.
    ``labels`` has the notices' labels too; both lists are distinct, sorted and joined by commas, empty without any.
    ``score`` is the greatest similarity of a span, 0 without one. A null text is empty and has no words. Rows are told
    apart by doc_id (null is one id) and text; repeated rows get equal results each. An empty table gives no rows,
    other columns are not read, and a text of any length is read whole.
    """
    templates, text_key = [*phrases, *notices], F.md5(whole_text())
    spans = find_spans(docs, templates, [F.col("doc_id"), text_key])
    base = F.col("template") < len(phrases)
    found = spans.groupBy("_k0", "_k1").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("similarity").alias("score"),
    )
    asked = docs.select("doc_id", text_key.alias("_key"), F.size(words_of(whole_text())).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("_k0")) & (F.col("_key") == F.col("_k1"))
    return asked.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
