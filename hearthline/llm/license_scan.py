"""License scans as an exact set-similarity join of text blocks with notice templates.

A text block is a window of ``2 * size`` words that begins at a multiple of ``size``; a template
is compared with the blocks of the smallest size that holds it, so a notice that stands together
lies whole in some block, however its lines are wrapped. Every block is found whose word set
holds at least ``threshold`` of a template's distinct words:

* the words of all templates are ordered by how many documents hold them, counted over the whole
  table, the rarest first;
* prefix filter: a block that reaches the threshold holds one of the template's first
  ``n - need + 1`` words, so only blocks around such rare words are looked at;
* length filter: the block has at least ``need`` distinct template words;
* positional filter: behind the first common word, what is left of both sorted sets suffices.

The templates are a parameter of bounded size; the counts that order their words come back to
the driver, one number per template word. Documents are not shuffled.

Defined results: a null or empty text has no words and no label; repeated rows are judged each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import in_portions, table, whole_text

THRESHOLD = 0.9
BLOCK_SIZES = (16, 32, 64, 128)

#: The phrases of the base labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Sentences by which licenses are commonly declared.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without "
            "restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "Licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International "
              "License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

_WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
_UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    """Words of ASCII letters, digits and all characters beyond ASCII; only A-Z is lower-cased."""
    return _WORD.findall(text.translate(_UPPER) if not text.isascii() else text.lower())


class TemplateIndex:
    """Templates sorted by the global word order, with their prefix words."""

    def __init__(self, templates, frequency: dict[str, int], threshold: float, sizes):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold must lie above 0 and not above 1")
        sets = [(label, set(words_of(text)), len(words_of(text))) for label, text in templates]
        vocabulary = sorted(
            {w for _, s, _ in sets for w in s}, key=lambda w: (frequency.get(w, 0), w)
        )
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.sizes: dict[int, list[tuple[str, list[int], int]]] = {}
        self.prefixes: dict[int, dict[int, list[int]]] = {}
        for label, held, length in sets:
            size = min((s for s in sizes if s >= length), default=length)
            order = sorted(self.rank[w] for w in held)
            need = math.ceil(round(threshold * len(order), 9))
            entries = self.sizes.setdefault(size, [])
            prefix = self.prefixes.setdefault(size, {})
            for rank in order[: len(order) - need + 1]:
                prefix.setdefault(rank, []).append(len(entries))
            entries.append((label, order, need))
        self.rare = {vocabulary[r] for p in self.prefixes.values() for r in p}

    def matches(self, words: list[str]) -> Iterator[tuple[str, float, int]]:
        """(label, containment, first word of the block) of every block over the threshold."""
        if self.rare.isdisjoint(words):
            return
        rank = self.rank
        ranks = [rank.get(w, -1) for w in words]
        for size, entries in self.sizes.items():
            prefix = self.prefixes[size]
            begins = set()
            for at, r in enumerate(ranks):
                if r in prefix:
                    begins.add(at // size * size)
                    begins.add(max(0, at // size - 1) * size)
            for begin in sorted(begins):
                block = sorted({r for r in ranks[begin : begin + 2 * size] if r >= 0})
                seen = set()
                for place, r in enumerate(block):
                    for i in prefix.get(r, ()):
                        if i in seen:
                            continue
                        seen.add(i)
                        label, order, need = entries[i]
                        if len(block) < need:
                            continue
                        left = min(len(order) - order.index(r), len(block) - place)
                        if left < need:
                            continue
                        common = len(set(order).intersection(block))
                        if common >= need:
                            yield label, common / len(order), begin


def places_of(words: list[str], phrases) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand consecutively."""
    found = []
    for phrase, label in phrases:
        first, *rest = phrase.split()
        if first not in words:
            continue
        found += [
            (i, label)
            for i, w in enumerate(words)
            if w == first and words[i + 1 : i + 1 + len(rest)] == rest
        ]
    return found


def word_frequencies(docs: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """Documents that hold each word of a bounded vocabulary, over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(vocabulary.intersection(words_of(text)))
        yield from in_portions(pd.DataFrame(list(counts.items()), columns=["word", "n"]))

    held = docs.select(whole_text().alias("text")).mapInPandas(count, "word string, n long")
    return {r["word"]: r["n"] for r in held.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def license_scan(
    docs: DataFrame,
    templates=TEMPLATES,
    phrases=PHRASES,
    threshold: float = THRESHOLD,
    sizes: tuple[int, ...] = BLOCK_SIZES,
) -> DataFrame:
    """One row per document: words, phrase places, labels, best containment and matched blocks."""
    vocabulary = {w for _, text in templates for w in words_of(text)}
    index = TemplateIndex(templates, word_frequencies(docs, vocabulary), threshold, sizes)

    @F.pandas_udf(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, "
        "blocks array<struct<label: string, containment: double, first_word: bigint>>"
    )
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text)
                places = places_of(words, phrases)
                blocks = list(index.matches(words))
                base = {label for _, label in places}
                starts = [at for at, _ in places]
                rows.append((
                    len(words), len(places), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | {b[0] for b in blocks})),
                    1.0 if places else max((b[1] for b in blocks), default=0.0),
                    [dict(zip(("label", "containment", "first_word"), b)) for b in blocks],
                ))
            frame = pd.DataFrame(rows, columns=[
                "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                "blocks",
            ])
            yield frame.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select("doc_id", scan(whole_text()).alias("found")).select("doc_id", "found.*")


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return license_scan(table(spark, sf_dir, "documents")).drop("blocks")


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _place_sql(phrase: str) -> str:
    """List of the places of a phrase in the list ``w``, from 0."""
    stands = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(phrase.split()))
    return f"list_filter(range(len(w)), lambda i: {stands})"


def _block_sql(label: str, text: str) -> str:
    """The best containment of a template in a block of ``w``, 0 below the threshold."""
    words = words_of(text)
    size = min((s for s in BLOCK_SIZES if s >= len(words)), default=len(words))
    held = sorted(set(words))
    need = math.ceil(round(THRESHOLD * len(held), 9))
    share = (
        f"list_transform(range(0, greatest(len(w), 1), {size}), lambda i: "
        f"len(list_intersect({_sql_list(held)}, w[i + 1 : i + {2 * size}])))"
    )
    return (
        f"CASE WHEN list_max({share}) >= {need} THEN list_max({share}) / {len(held)}.0::DOUBLE "
        "ELSE 0.0 END"
    )


OP10_SQL = f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
found AS (
  SELECT doc_id, len(w) AS n_words,
         {", ".join(f"{_place_sql(p)} AS p{k}" for k, (p, _) in enumerate(PHRASES))},
         {", ".join(f"{_block_sql(*t)} AS t{k}" for k, t in enumerate(TEMPLATES))}
  FROM split),
labelled AS (
  SELECT doc_id, n_words, {" || ".join(f"p{k}" for k in range(len(PHRASES)))} AS places,
         {" || ".join(f"CASE WHEN len(p{k}) > 0 THEN ['{label}'] ELSE [] END"
                      for k, (_, label) in enumerate(PHRASES))} AS base,
         {" || ".join(f"CASE WHEN t{k} > 0 THEN ['{label}'] ELSE [] END"
                      for k, (label, _) in enumerate(TEMPLATES))} AS more,
         greatest({", ".join(f"t{k}" for k in range(len(TEMPLATES)))}) AS best
  FROM found)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       CAST(list_min(places) AS BIGINT) AS first_word,
       CAST(list_max(places) AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || more)), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0 ELSE best END AS score
FROM labelled"""
