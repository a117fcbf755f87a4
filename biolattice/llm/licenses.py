"""Operator 1, license scans: an exact set-similarity join of text blocks with notice templates, in DataFrame operations."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Phrases and labels of the base scan.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wordings of common notices and the label of each.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("reserved", "All rights reserved"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # the word characters before lower-casing
OUT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def _tokens(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), OUT_WORD + "+"), lambda w: w != "")


def _whole(phrases: Sequence[str]) -> str:
    """Pattern of the phrases as whole words, A-Z in either case."""
    gap = OUT_WORD + "+"
    return f"(?i)(?<!{IN_WORD})(?:{'|'.join(gap.join(p.split()) for p in phrases)})(?!{IN_WORD})"


def token_counts(docs: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """Number of texts with each of the tokens, over all texts. Only these counts reach the driver."""
    words = F.split(F.lower("text"), OUT_WORD + "+")
    found = docs.select(F.explode(F.array_intersect(F.array(*map(F.lit, tokens)), words)).alias("token"))
    return {r.token: r["count"] for r in found.groupBy("token").count().collect()}


class Index:
    """The templates of one block length: tokens in order of rarity, and a prefix index.

    A block is `width` words and blocks begin every width/2 words, so that a notice of up to width/2 words
    lies whole in one block. A block matches a template if it has at least `share` of the template's
    different tokens.
    """

    def __init__(self, templates: list[tuple[str, list[str]]], counts: dict[str, int], width: int, share: tuple[int, int]):
        self.width = width
        vocabulary = sorted({t for _, ts in templates for t in ts}, key=lambda t: (counts.get(t, 0), t))
        rank = {t: i for i, t in enumerate(vocabulary)}
        self.vocabulary, self.rows, self.index = vocabulary, [], {}
        for label, ts in templates:
            ordered = sorted(set(ts), key=rank.get)
            need = -(-len(ordered) * share[0] // share[1])
            for i, t in enumerate(ordered[:len(ordered) - need + 1]):  # the prefix: one of these must be met
                self.index.setdefault(t, []).append((len(self.rows), i, len(ordered), need))
            self.rows.append((label, ordered, need))

    def matches(self, words: Column) -> Column:
        """Array of (label, share of the template found) of every match of the blocks of a word array."""
        w, half = self.width, self.width // 2
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - half, F.lit(1)), F.lit(half))
        rare = F.array(*map(F.lit, self.index))
        blocks = F.filter(F.transform(starts, lambda s: F.slice(words, s, F.lit(w))), lambda b: F.arrays_overlap(b, rare))
        # only template tokens count, in order of rarity
        ordered = F.transform(blocks, lambda b: F.array_intersect(F.array(*map(F.lit, self.vocabulary)), b))
        entry = lambda e: F.struct(*[F.lit(v).alias(n) for v, n in zip(e, ("t", "i", "n", "need"))])
        lists = F.create_map(*[x for t, es in self.index.items() for x in (F.lit(t), F.array(*map(entry, es)))])
        plans = F.array(*[F.struct(F.lit(a).alias("label"), F.array(*map(F.lit, ts)).alias("tokens"), F.lit(k).alias("need"))
                          for a, ts, k in self.rows])

        def candidates(b: Column) -> Column:
            # length filter and positional filter: what is left behind this token on both sides must suffice
            fits = lambda e, j: ((F.size(b) >= e["need"])
                                 & (1 + F.least(e["n"] - e["i"] - 1, F.size(b) - j - 1) >= e["need"]))
            met = F.transform(b, lambda t, j: F.transform(
                F.filter(F.coalesce(F.element_at(lists, t), F.array().cast("array<struct<t:int,i:int,n:int,need:int>>")), lambda e: fits(e, j)),
                lambda e: e["t"]))
            return F.array_distinct(F.flatten(met))

        def verified(b: Column) -> Column:
            pairs = F.transform(candidates(b), lambda t: F.struct(
                F.get(plans, t)["label"].alias("label"), F.get(plans, t)["need"].alias("need"), F.size(F.get(plans, t)["tokens"]).alias("n"),
                F.size(F.array_intersect(F.get(plans, t)["tokens"], b)).alias("hits")))
            return F.transform(F.filter(pairs, lambda p: p["hits"] >= p["need"]),
                               lambda p: F.struct(p["label"].alias("label"), (p["hits"] / p["n"]).alias("share")))

        return F.flatten(F.transform(ordered, verified))


def indexes(docs: DataFrame, templates: Sequence[tuple[str, str]], share: tuple[int, int]) -> list[Index]:
    parsed = [(label, _tokens(text)) for label, text in templates]
    counts = token_counts(docs, sorted({t for _, ts in parsed for t in ts}))
    by_width: dict[int, list] = {}
    for label, ts in parsed:
        by_width.setdefault(2 << max(2, (len(ts) - 1).bit_length()), []).append((label, ts))
    return [Index(ts, counts, width, share) for width, ts in sorted(by_width.items())]


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base columns tell the places of PHRASES. `labels` adds the label of every template of which some
    block of the text has at least `share` (a fraction) of the different tokens; score is the largest share
    found, 1 where a phrase stands, 0 without a match. Templates are a parameter of bounded size and are
    laid into the plan; texts are read twice, for the token counts and for the scan, and nothing of them is
    shuffled. Null texts count as empty: no words, no labels, null first_word and last_word. Repeated rows
    give repeated results; an empty table gives no rows; other columns are not looked at.
    """
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    plans = indexes(d, templates, share)
    count = lambda c: F.regexp_count(c, F.lit(IN_WORD + "+"))
    phrase = _whole(list(PHRASES))
    d = d.withColumn("_n", count(F.col("text"))).withColumn("_found", F.regexp_extract_all("text", F.lit(phrase), F.lit(0)))
    any_found = F.size("_found") > 0
    parts = F.split("text", phrase)
    first = F.when(any_found, count(F.get(parts, F.lit(0))))
    last = F.when(any_found, F.col("_n") - count(F.element_at(parts, -1)) - count(F.element_at("_found", -1)))
    name = lambda m: F.coalesce(*[F.when(F.lower(m).startswith(p.split()[0]), F.lit(a)) for p, a in PHRASES.items()])
    rare = _whole(sorted({t for p in plans for t in p.index}))
    words = F.when(F.col("text").rlike(rare), _words(F.col("text")))
    d = d.withColumn("_words", words).withColumn("_base", F.array_distinct(F.transform("_found", name)))
    none = F.array().cast("array<struct<label:string,share:double>>")
    d = d.withColumn("_more", F.when(F.col("_words").isNotNull(), F.flatten(F.array(*[p.matches(F.col("_words")) for p in plans]))).otherwise(none))
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    best = F.aggregate("_more", F.lit(0.0), lambda a, m: F.greatest(a, m["share"]))
    return d.select("doc_id", F.col("_n").cast("long").alias("n_words"), F.size("_found").cast("long").alias("n_base"),
                    first.cast("long").alias("first_word"), last.cast("long").alias("last_word"), text(F.col("_base")).alias("base_labels"),
                    text(F.concat(F.col("_base"), F.transform("_more", lambda m: m["label"]))).alias("labels"),
                    F.when(any_found, F.lit(1.0)).otherwise(best).alias("score"))


def scan_sql(templates: Sequence[tuple[str, str]] = TEMPLATES) -> str:
    """The same rows by comparing every block with every template."""
    lit = lambda ts: "[" + ", ".join(f"'{t}'" for t in ts) + "]"
    widths = [(2 << max(2, (len(_tokens(t)) - 1).bit_length())) for _, t in templates]
    rows = ", ".join(f"('{a}', {lit(sorted(set(_tokens(t))))}, {w})" for (a, t), w in zip(templates, widths))
    places = []
    for p, a in PHRASES.items():
        cond = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split()))
        places.append(f"SELECT doc_id, i - 1 AS place, '{a}' AS label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE {cond}")
    return rf"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t(label, tokens, width) AS (VALUES {rows}),
base AS ({' UNION ALL '.join(places)}),
blocks AS (SELECT doc_id, width, list_distinct(w[s:s + width - 1]) AS b FROM (SELECT doc_id, width, w, unnest(range(1, greatest(len(w) - width // 2, 1) + 1, width // 2)) AS s
  FROM d, (SELECT DISTINCT width FROM t))),
more AS (SELECT doc_id, label, max(len(list_intersect(b, tokens)) / len(tokens)) AS share FROM blocks JOIN t USING (width)
  WHERE 5 * len(list_intersect(b, tokens)) >= 4 * len(tokens) GROUP BY ALL),
found AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
names AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM more) GROUP BY doc_id),
best AS (SELECT doc_id, max(share) AS share FROM more GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN found USING (doc_id) LEFT JOIN names USING (doc_id) LEFT JOIN best USING (doc_id)"""
