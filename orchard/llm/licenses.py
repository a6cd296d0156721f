"""License statements: fixed phrases plus an exact set-similarity join with templates.

A text block is a window of ``BLOCK`` words, for longer templates of ``BLOCK`` doubled until it
holds twice the template's words; one starts every half block, so that a passage as long as the
template stands whole in some block whatever its line breaks. A block
matches a template when it holds at least ``CONTAINMENT`` of the template's distinct words.
Words are ordered by their frequency over all documents, rarest first. Then

* prefix filter: a block that holds ``need`` of a template's n words holds one of its
  n - need + 1 rarest,
* length filter: it holds at least ``need`` words that any template has,
* positional filter: the words after the first common one, on either side, must suffice,

and what is left is counted exactly. The templates are a list in the query.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import Scratch, lower_ascii

# Base phrases and their labels
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Statements of public licenses
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                   "with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
            "rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text
BLOCK = 128
CONTAINMENT = 0.8


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _template_words(text: str) -> list[str]:
    kept = "".join(c if c.isalnum() else " " for c in text.lower())
    return sorted(set(kept.split()))


def block_words(text: str) -> int:
    """Words of the text blocks that a template is compared with."""
    size, least = BLOCK, 2 * len("".join(c if c.isalnum() else " " for c in text.lower()).split())
    while size < least:
        size *= 2
    return size


def places(words: Column, phrase: str) -> Column:
    """Starts of a phrase in an array of words, counted from 0."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(words) - len(parts))
    hit = F.filter(starts, lambda i: _all(F.get(words, i + k) == p for k, p in enumerate(parts)))
    return F.when((F.size(words) >= len(parts)) & _all(F.array_contains(words, p) for p in parts), hit).otherwise(
        F.array().cast("array<int>"))


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def frequency_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> list[str]:
    """``vocabulary`` from the word that is rarest over all documents on; ties by the word.

    The driver gets one count per word of the vocabulary.
    """
    hits = docs.select(F.explode(F.filter(words_of(F.col(text_col)), lambda w: w.isin(vocabulary))).alias("w"))
    counts = {r["w"]: r["n"] for r in hits.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, phrase_starts, phrase_labels, labels, score.

    ``phrase_starts`` holds the starts of every place of every base phrase, ``labels`` also the
    labels of templates some block contains. ``score`` is 1 where a phrase stands, else the
    largest containment found, else 0. Null and empty texts have no words and no labels.
    Templates are joined per id and text, so equal rows get equal results and ids that
    repeat with other texts (or are null) stay apart. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    sets = [(k, label, _template_words(text), block_words(text)) for k, (label, text) in enumerate(templates)]
    order = frequency_order(docs, sorted({w for _, _, ws, _ in sets for w in ws}), text_col)
    rank = {w: k for k, w in enumerate(order)}
    index, prefixes = [], set()
    for k, label, ws, size in sets:
        ranks = sorted(rank[w] for w in ws)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        for i, r in enumerate(ranks[: len(ranks) - need + 1]):
            index.append((k, label, size, r, i, need, ranks))
            prefixes.add(order[r])
    prefix_words = F.array(*[F.lit(w) for w in sorted(prefixes)])
    ordered = F.array(*[F.lit(w) for w in order])

    words = F.col("words")

    def blocks_of(size: int) -> Column:
        step = size // 2
        every = F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / step).cast("int")),
                            lambda b: F.slice(words, b * step + 1, F.lit(size)))
        likely = F.filter(every, lambda block: F.arrays_overlap(block, prefix_words))
        return F.transform(likely, lambda block: F.struct(F.lit(size).alias("size"), F.array_sort(F.transform(
            F.array_distinct(F.filter(block, lambda w: w.isin(order))),
            lambda w: F.array_position(ordered, w).cast("int") - 1)).alias("ranks")))

    ranked = F.concat(*[blocks_of(size) for size in sorted({size for *_, size in sets} or {BLOCK})])
    blocks = F.when(F.arrays_overlap(words, prefix_words), ranked).otherwise(
        F.array().cast("array<struct<size:int,ranks:array<int>>>"))
    found = [places(words, p) for p, _ in PHRASES]
    labels = F.filter(F.array(*[F.when(F.size(f) > 0, F.lit(label)) for f, (_, label) in zip(found, PHRASES)]),
                      lambda x: x.isNotNull())
    rows = scratch.write(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"),
                    words_of(F.col(text_col)).alias("words"))
        .select("doc_id", "h", F.size(words).cast("long").alias("n_words"),
                F.flatten(F.array(*found)).alias("phrase_starts"), F.array_sort(labels).alias("phrase_labels"),
                blocks.alias("blocks")), "rows")

    block = F.posexplode(F.array_distinct("blocks")).alias("block", "own")
    hit = rows.where(F.size("blocks") > 0).select("doc_id", "h", block).select(
        "doc_id", "h", "block", "own.size", "own.ranks", F.posexplode("own.ranks").alias("at", "rank"))
    listed = spark.createDataFrame(index, "template int, label string, size int, rank int, place int, need int, template_ranks array<int>")
    n_block, n_template = F.size("ranks"), F.size("template_ranks")
    candidates = (hit.join(F.broadcast(listed), ["size", "rank"])  # one row per template and prefix word
                  .where(n_block >= F.col("need"))
                  .where(1 + F.least(n_block - F.col("at") - 1, n_template - F.col("place") - 1) >= F.col("need")))
    shared = F.size(F.array_intersect("ranks", "template_ranks"))
    matched = (candidates.where(shared >= F.col("need"))
               .groupBy("doc_id", "h").agg(F.collect_set("label").alias("template_labels"),
                                           F.max(shared / n_template).alias("containment")))
    right = matched.select(F.col("doc_id").alias("m_id"), F.col("h").alias("m_h"), "template_labels", "containment")
    both = rows.drop("blocks").join(right, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("h") == F.col("m_h")), "left")
    none = F.array().cast("array<string>")
    return both.select(
        "doc_id", "n_words", "phrase_starts", "phrase_labels",
        F.array_sort(F.array_union("phrase_labels", F.coalesce("template_labels", none))).alias("labels"),
        F.when(F.size("phrase_labels") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))


def oracle(templates: Sequence[tuple[str, str]] = TEMPLATES) -> str:
    """DuckDB: every block of every document counted against every template."""
    rows = ", ".join(f"({k}, '{label}', {_template_words(text)!r})" for k, (label, text) in enumerate(templates))
    return rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
base AS (SELECT r, i - 1 AS start, CASE WHEN w[i:i + 1] = ['cc', 'by'] THEN 'cc-by'
    WHEN w[i:i + 2] = ['general', 'public', 'license'] THEN 'gpl'
    WHEN w[i:i + 2] = ['all', 'rights', 'reserved'] THEN 'reserved' END AS label
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs)
  WHERE w[i] IN ('cc', 'general', 'all')),
places AS (SELECT r, count(*) AS n, min(start) AS lo, max(start) AS hi, list_sort(list(DISTINCT label)) AS labels
  FROM base WHERE label IS NOT NULL GROUP BY r),
t(k, label, words) AS (VALUES {rows}),
blocks AS (SELECT r, w[b * 64 + 1:b * 64 + 128] AS block FROM
  (SELECT r, w, unnest(range(0, CASE WHEN len(w) > 0 THEN (len(w) - 1) // 64 + 1 ELSE 0 END)) AS b FROM docs)),
matched AS (SELECT r, list(DISTINCT label) AS labels, max(len(list_intersect(words, block)) / len(words)) AS score
  FROM blocks, t WHERE len(list_intersect(words, block)) >= ceil(0.8 * len(words) - 1e-9) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
  CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
  coalesce(array_to_string(p.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(p.labels, []), coalesce(m.labels, [])))), ','), '')
    AS labels,
  CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(score, 0) END AS DOUBLE) AS score
FROM docs LEFT JOIN places p USING (r) LEFT JOIN matched m USING (r)
"""
