"""License scan: an exact set-similarity join of text blocks with license templates (DataFrame functions only).

A block is a window of ``WINDOW`` consecutive words; windows begin every ``STRIDE`` words and run across line ends, so
a notice of up to ``WINDOW - STRIDE + 1`` words lies whole in one of them however its lines are wrapped, and words that
are scattered over a text do not come together. A block matches a template when it holds at least ``threshold`` of
the template's distinct words (containment). Words are ordered globally from rare to frequent, by the number of
blocks that hold them. With o = ceil(threshold * template size):

* length filter: a block with fewer than o of the templates' words cannot match;
* prefix filter: in the global order, the first (size - o + 1) words of a matching block and of its template
  share a word, so only those words of both sides are joined;
* positional filter: from the first shared word on, enough words must be left on both sides.

Candidates are verified exactly. The template side is fixed and small: its index has at most one row per word of
a template, whatever the documents, and is broadcast. Blocks are cut down to template words in the only pass over the
texts, which also finds the base phrases. No text is shuffled. Blocks stay within their document's row until they
are exploded, so a hot source or a frequent line is spread like any other rows.

A document is a distinct (id, text); repeated rows share the result, one row each. Null text is empty: no words,
no labels, score 0. Null ids are kept. Other columns are ignored. An empty table gives an empty result. Long texts are
scanned whole, their windows one by one. Ties in the order of words are broken by the word.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import ascii_lower, stage

# word separators, before lower-casing
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
THRESHOLD = 0.9
WINDOW, STRIDE = 40, 20

# label, notice of at most WINDOW - STRIDE + 1 words
TEMPLATES = [
    ("agpl", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("apache-2.0", "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"),
    ("bsd", "Released under the BSD License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def template_words(text: str) -> list[str]:
    return sorted(set("".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()))


def overlap_needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * size, 9)))


def _base_columns(joined):
    """Places of the base phrases in ``joined`` (words with one space between, before and after)."""
    phrase = "(?i) (?=(?:" + "|".join(BASE) + ") )"
    parts = F.split(joined, phrase, -1)
    spaces = lambda c: F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))
    found = joined.rlike(phrase)
    labels = [F.when(joined.rlike(f"(?i) {p} "), F.lit(v)) for p, v in BASE.items()]
    return [
        F.when(found, F.size(parts) - 1).otherwise(0).cast("bigint").alias("n_base"),
        F.when(found, spaces(F.get(parts, F.lit(0)))).cast("bigint").alias("first_word"),
        F.when(found, F.col("n_words") - spaces(F.element_at(parts, -1))).cast("bigint").alias("last_word"),
        F.when(found, F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))))
        .otherwise(F.array().cast("array<string>"))
        .alias("base"),
    ]


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks."""
    spark = docs.sparkSession
    sets = sorted({(label, *template_words(t)) for label, t in templates or TEMPLATES})
    sizes = [(t[0], t[1:], overlap_needed(len(t) - 1, threshold)) for t in sets]
    vocab = sorted({w for _, ws, _ in sizes for w in ws})
    least = min(o for *_, o in sizes)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def blocks_of(words):
        """The template words of each window that has enough of them."""
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - (WINDOW - STRIDE) - 1), F.lit(STRIDE))
        found = F.transform(
            starts, lambda i: F.array_intersect(F.array(*map(F.lit, vocab)), F.slice(words, i + 1, F.lit(WINDOW)))
        )
        return F.filter(found, lambda b: F.size(b) >= least)

    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    rows = rows.withColumn("plain", F.trim(F.regexp_replace("text", SEPARATORS, " "))).withColumn(
        "n_words",
        F.when(F.col("plain") == "", 0)
        .otherwise(F.char_length("plain") - F.char_length(F.replace("plain", F.lit(" "), F.lit(""))) + 1)
        .cast("bigint"),
    )
    # the words are bound to a lambda's variable, so that they are not split anew for every window
    blocks = F.transform(F.array(F.split(ascii_lower(F.col("plain")), " ")), blocks_of)[0]
    rows = stage(
        rows.select(
            "doc_id", "text_hash", "n_words", *_base_columns(F.concat(F.lit(" "), "plain", F.lit(" "))),
            blocks.alias("blocks"),
        ),
        "license-blocks",
    )

    # the global order; at most one row per template word comes to the driver
    each = rows.select("doc_id", "text_hash", F.explode("blocks").alias("b"))
    freq = dict(each.select(F.explode("b").alias("w")).groupBy("w").count().collect())
    ordered = sorted(vocab, key=lambda w: (freq.get(w, 0), w))
    rank = {w: i for i, w in enumerate(ordered)}
    index = [
        (w, j, label, o, size := len(ws), sorted(ws, key=rank.get))
        for label, ws, o in sizes
        for j, w in enumerate(sorted(ws, key=rank.get)[: len(ws) - o + 1])
    ]
    index = spark.createDataFrame(index, "word string, j int, label string, o int, size int, t array<string>")

    b = F.array_intersect(F.array(*map(F.lit, ordered)), F.col("b"))
    prefixes = each.withColumn("b", b).select(
        "doc_id", "text_hash", "b", F.posexplode(F.slice("b", F.lit(1), F.size("b") - least + 1)).alias("i", "word")
    )
    left = lambda n, at: n - F.col(at)  # noqa: E731  words from this one on
    candidates = prefixes.join(F.broadcast(index), "word").filter(
        (F.size("b") >= F.col("o"))
        & (F.least(left(F.size("b"), "i"), left(F.col("size"), "j")) >= F.col("o"))
        & (F.get(F.array_intersect("b", "t"), F.lit(0)) == F.col("word"))  # once per pair: at its first shared word
    )
    shared = F.size(F.array_intersect("b", "t"))
    matches = (
        candidates.filter(shared >= F.col("o"))
        .select("doc_id", "text_hash", "label", (shared / F.col("size")).alias("containment"))
        .groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"))
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"), F.count("*").alias("pairs"))
    )
    joined = rows.drop("blocks").join(
        matches, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left"
    )
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", none))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("pairs", F.lit(0)).cast("bigint").alias("n_matches"),
    )


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for the scan of ``documents``: every block is compared with every template."""
    rows = ",".join(
        f"('{t[0]}', [{','.join(repr(w) for w in t[1:])}], {overlap_needed(len(t) - 1, threshold)})"
        for t in sorted({(label, *template_words(text)) for label, text in TEMPLATES})
    )
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH t(label, ws, o) AS (VALUES {rows}),
d AS (SELECT doc_id, translate(coalesce(text, ''), '{up}', '{low}') AS s FROM documents),
w AS (SELECT doc_id, s, regexp_extract_all(s, '{word}') AS ws FROM d),
p AS (SELECT doc_id, s, ws, list_concat(
  list_transform(list_filter(range(len(ws)), lambda i: ws[i+1]='cc' AND ws[i+2]='by'), lambda i: {{'i': i, 'l': 'cc-by'}}),
  list_transform(list_filter(range(len(ws)), lambda i: ws[i+1]='general' AND ws[i+2]='public' AND ws[i+3]='license'),
    lambda i: {{'i': i, 'l': 'gpl'}}),
  list_transform(list_filter(range(len(ws)), lambda i: ws[i+1]='all' AND ws[i+2]='rights' AND ws[i+3]='reserved'),
    lambda i: {{'i': i, 'l': 'reserved'}})) AS b FROM w),
blocks AS (SELECT doc_id, ws[i+1:i+{WINDOW}] AS b
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(1, len(ws) - {WINDOW - STRIDE}), {STRIDE})) AS i FROM w)),
m AS (SELECT doc_id, label, len(list_intersect(t.ws, b)) / len(t.ws) AS c FROM blocks, t WHERE len(list_intersect(t.ws, b)) >= o),
g AS (SELECT doc_id, list(DISTINCT label) AS found, max(c) AS best, count(*) AS pairs FROM m GROUP BY doc_id)
SELECT p.doc_id, len(ws)::BIGINT AS n_words, len(b)::BIGINT AS n_base,
  list_min(list_transform(b, lambda x: x.i))::BIGINT AS first_word, list_max(list_transform(b, lambda x: x.i))::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(b, lambda x: x.l))), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(b, lambda x: x.l), found))), ','), '') AS labels,
  CASE WHEN len(b) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score,
  coalesce(pairs, 0)::BIGINT AS n_matches
FROM p LEFT JOIN g ON g.doc_id = p.doc_id"""
