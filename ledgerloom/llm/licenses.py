"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words, whatever line breaks lie in it, as long as the template
it is held against: the template's number of words divided by the threshold (fewer at the end of
a text). It meets the template if it has at least the threshold share of the template's distinct
words. Blocks begin at every word of the template in the text: one that began before its first
such word would have no more of them.

Words are ordered by their frequency over all documents, rarest first. Of a template's distinct
words a block must have enough in all (length filter), and its rarest one must stand within the
first |T| - overlap + 1 of the order (prefix filter); what remains from there on must suffice for
the overlap (positional filter). Blocks that pass are counted exactly, so the join finds every
pair.

Templates are a table of (label, text), small enough to go along with every task; texts are
scanned where they lie, without a shuffle.

Besides, places of base phrases are found: runs of consecutive words.

Defined cases: null texts count as empty and have no words, places or matches; very long
texts are scanned whole; repeated rows are scanned each; extra columns stay; an empty table
gives no rows.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import utf8
from ledgerloom.llm.words import blocks, find_words, same_words

THRESHOLD = 0.8
#: Characters of all templates together, which every task holds.
MAX_TEMPLATE_CHARS = 8 << 20

# Phrases that mark a license, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences of well-known license notices, with their labels.
TEMPLATES = {
    "Released under the MIT License": "mit-notice",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3.0",
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl-2.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit-grant",
}

# Paragraphs of well-known license notices, with their labels.
NOTICES = {
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software": "mit-terms",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT': "mit-terms",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "bsd-terms",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-terms",
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED': "bsd-terms",
    "you may not use this file except in compliance with the License. You may obtain a copy of the License at": "apache-terms",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied': "apache-terms",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "gnu-terms",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE": "gnu-terms",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means": "unlicense",
}


@dataclass(frozen=True)
class Templates:
    """Templates with their words as ranks in the global order, rarest first."""

    words: list
    labels: list
    ranks: list
    needed: list
    block_words: list

    @property
    def vocabulary(self):
        """(the template words, their ranks by hash)."""
        words = find_words([b" ".join(self.words)], lower=False)
        return words, np.argsort(words.hash, kind="stable")


def _template_words(templates):
    """(distinct words of every template, number of all its words)."""
    cut = find_words([t.encode() for t in templates])
    distinct = [
        sorted({cut.text(i) for i in range(cut.bounds[t], cut.bounds[t + 1])})
        for t in range(len(templates))
    ]
    return distinct, np.diff(cut.bounds).tolist()


def word_counts(documents: DataFrame, words) -> dict:
    """Occurrences of each given word over all whole texts."""
    known = sorted(words)
    hashes = find_words([b" ".join(known)], lower=False).hash
    order = np.argsort(hashes)

    def count(batches):
        total = np.zeros(len(known), dtype=np.int64)
        for rows in batches:
            texts = list(rows["text"])
            for first, last in blocks(texts):
                found = find_words(texts[first:last]).hash
                at = np.minimum(np.searchsorted(hashes[order], found), len(known) - 1)
                hit = hashes[order][at] == found
                total += np.bincount(order[at[hit]], minlength=len(known))
        yield pd.DataFrame({"word": np.arange(len(known)), "n": total})

    parts = documents.select(utf8("text").alias("text")).mapInPandas(count, "word long, n long")
    rows = parts.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {known[r["word"]]: r["n"] for r in rows}


def template_table(spark, templates=None) -> DataFrame:
    """(label, text) of the templates known here, or of a dictionary of texts and labels."""
    pairs = TEMPLATES | NOTICES if templates is None else templates
    return spark.createDataFrame([(label, text) for text, label in pairs.items()], "label string, text string")


def prepare_templates(documents: DataFrame, templates: DataFrame, threshold=THRESHOLD) -> Templates:
    """A table of templates (label, text) in the order of the corpus' own word frequencies.

    Templates without a word are left out; equal ones count once for each label.
    """
    known = templates.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("label", "text"))).distinct()
    chars = known.agg(F.sum(F.length("text"))).first()[0] or 0
    if chars > MAX_TEMPLATE_CHARS:
        raise ValueError(f"{chars} characters of templates, at most {MAX_TEMPLATE_CHARS} allowed")
    pairs = sorted((r["text"], r["label"]) for r in known.collect())
    sets, sizes = _template_words([text for text, _ in pairs])
    chosen = [k for k, own in enumerate(sets) if own]
    sets, sizes = [sets[k] for k in chosen], [sizes[k] for k in chosen]
    every = sorted(set().union(*sets))
    counts = word_counts(documents, every) if every else {}
    ordered = sorted(every, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(ordered)}
    return Templates(
        ordered,
        [pairs[k][1] for k in chosen],
        [sorted(rank[w] for w in s) for s in sets],
        [int(np.ceil(threshold * len(s) - 1e-9)) for s in sets],
        [int(np.ceil(n / threshold - 1e-9)) for n in sizes],
    )


def _ranks(words, templates):
    """Rank of every word, -1 outside the templates."""
    known, order = templates.vocabulary
    hashes, out = known.hash[order], np.full(len(words.hash), -1, dtype=np.int64)
    first, last = np.searchsorted(hashes, words.hash, "left"), np.searchsorted(hashes, words.hash, "right")
    # A hash stands for one word, in all likelihood; the words are compared all the same.
    for step in range(int((last - first).max(initial=0))):
        at = np.flatnonzero(first + step < last)
        rank = order[first[at] + step]
        same = same_words(words, at, known, rank)
        out[at[same]] = rank[same]
    return out


def _rarest(positions, first, last):
    """The least of positions[first:last], for every pair of bounds (none empty)."""
    span = last - first
    out, levels, k = np.empty(len(first), dtype=np.int64), positions, 0
    while len(out) and (1 << k) <= int(span.max()):
        here = np.flatnonzero((span >> k) == 1)
        out[here] = np.minimum(levels[first[here]], levels[last[here] - (1 << k)])
        if len(levels) <= 1 << k:
            break
        levels, k = np.minimum(levels[: -(1 << k)], levels[1 << k :]), k + 1
    return out


def join_blocks(words, doc, templates: Templates):
    """Every (template, first word, end word, shared words) of a block that reaches its overlap."""
    out = []
    if not len(words.start) or not templates.words:
        return out
    rank = _ranks(words, templates)
    known = np.flatnonzero(rank >= 0)
    for t, own in enumerate(templates.ranks):
        needed, own = templates.needed[t], np.array(own)
        position = np.searchsorted(own, rank[known])
        mine = own[np.minimum(position, len(own) - 1)] == rank[known]
        first, position = known[mine], position[mine]
        end = np.minimum(first + templates.block_words[t], words.bounds[doc[first] + 1])
        at, upto = np.arange(len(first)), np.searchsorted(first, end)
        rarest = _rarest(position, at, upto)
        reach = np.minimum(len(own) - rarest, upto - at)
        # The prefix says rarest <= |T| - overlap; length and position bound what a block can share.
        for i in np.flatnonzero((rarest <= len(own) - needed) & (reach >= needed)).tolist():
            shared = len(set(position[i : upto[i]].tolist()))
            if shared >= needed:
                out.append((t, first[i], end[i], shared))
    return out


def phrase_places(words, phrases=PHRASES):
    """(label, index of the first word) of every place of a phrase."""
    out, doc = [], words.doc()
    for phrase, label in phrases.items():
        wanted = phrase.encode().split()
        hashes = find_words([phrase.encode()]).hash
        n = len(wanted)
        if len(words.start) < n:
            continue
        hit = doc[: len(doc) - n + 1] == doc[n - 1 :]
        for k in range(n):
            hit &= words.hash[k : len(doc) - n + 1 + k] == hashes[k]
        out += [
            (label, int(i))
            for i in np.flatnonzero(hit)
            if all(words.text(i + k) == wanted[k] for k in range(n))
        ]
    return out


def scan_texts(texts, templates: Templates, phrases=PHRASES):
    """(words, base places, matches) of every UTF-8 text."""
    counts, base, found = [], [[] for _ in texts], [[] for _ in texts]
    for first, last in blocks(texts):
        words = find_words(texts[first:last])
        doc = words.doc()
        counts += np.diff(words.bounds).tolist()
        for label, at in phrase_places(words, phrases):
            d = int(doc[at])
            base[first + d].append({"label": label, "word": at - int(words.bounds[d])})
        for t, begin, end, shared in join_blocks(words, doc, templates):
            d = int(doc[begin])
            found[first + d].append(
                {
                    "label": templates.labels[t],
                    "first_word": int(begin - words.bounds[d]),
                    "n_words": int(end - begin),
                    "containment": shared / len(templates.ranks[t]),
                }
            )
    return counts, base, found


_FIELDS = (
    "n_words long, base array<struct<label:string,word:long>>, "
    "found array<struct<label:string,first_word:long,n_words:long,containment:double>>"
)


def with_licenses(documents: DataFrame, templates: Templates, column: str = "licenses") -> DataFrame:
    """Add a struct: n_words, base (phrase places), found (blocks that meet a template).

    A column of the name is replaced.
    """
    sent = vars(templates)

    @F.pandas_udf(_FIELDS)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        counts, base, found = scan_texts(list(texts), Templates(**sent))
        return pd.DataFrame({"n_words": counts, "base": base, "found": found})

    return documents.withColumn(column, scanned(utf8("text")))
