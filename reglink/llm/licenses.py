"""License scans: base phrases and an exact set-similarity join of text
blocks with license templates.

A block is a paragraph: a run of lines that each have a word. A template
holds in a block if some window of the block, of at most ``SPREAD`` times the
template's words, contains at least ``THRESHOLD`` of its distinct words and
what sets it apart from the notices of other licenses (``DECIDING``). The
window keeps the test as strict in a long block as in a short one. The join is
exact and cheap by three filters over tokens in ascending order of their
frequency in all blocks of the corpus:

- prefix: a template of t words of which r are required can only be met by a
  block with one of its t - r + 1 rarest words, so blocks are looked up
  through an inverted index of those words alone;
- length: the block needs at least r words;
- position: if the rarest shared word is the template's p-th, at most t - p
  words are shared, which must still reach r.

Survivors are verified in windows slid over the whole block. Templates are few and fixed, so
their index travels with the task; the documents are never shuffled.

Null texts count as empty and have no words. Repeated rows each give their
row; further columns are passed over.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import frames
from reglink.llm.text import ALNUM, find_words, slices

THRESHOLD = 0.8
SPREAD = 2

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of public licenses, by label and form.
TEMPLATES = {
    "mit/short": "Released under the MIT License",
    "apache/short": "Licensed under the Apache License, Version 2.0",
    "gpl/short": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc/short": "Licensed under CC BY-NC 4.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "apache": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "cc-by": "This work is licensed under a Creative Commons Attribution International License. To view a copy of this license, visit http://creativecommons.org/licenses/by",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
}

# Of every group a window must hold one phrase, at a place where
# none of the words given with it (those of another license) comes next.
LICENSE = {"license": (), "licence": ()}
CC_BY = {"creative commons attribution": ("noncommercial", "non", "sharealike", "share", "noderivatives", "noderivs", "no")}
DECIDING = {
    "mit/short": [{"mit": ()}, LICENSE],
    "apache/short": [{"apache": ()}, LICENSE],
    "gpl/short": [{"gnu general public": ()}],
    "cc-by-nc/short": [{"by nc": ("sa", "nd")}],
    "apache": [{"apache": ()}],
    "gpl": [{"gnu general public": ()}],
    "mpl": [{"mozilla": ()}],
    "cc-by": [CC_BY],
}


def _tokens(texts: list[str]):
    return find_words(pa.array(texts, pa.large_string()), ALNUM, True)


class Lexicon:
    """Word hash to token number, for the few words that matter."""

    BITS = 16

    def __init__(self, hashes: np.ndarray):
        self.known = np.unique(hashes)
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[(self.known >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words and their token numbers."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        token = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        right = self.known[token] == hashes[at]
        return at[right], token[right]


class Templates:
    def __init__(self, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, deciding: dict[str, list[dict]] = DECIDING):
        self.labels = [name.partition("/")[0] for name in templates]
        w = _tokens(list(templates.values()))
        hashes = w.hashes()
        self.lexicon = Lexicon(hashes)
        self.sets = [set(np.searchsorted(self.lexicon.known, hashes[w.first[i]:w.first[i + 1]]).tolist()) for i in range(len(templates))]
        self.required = [math.ceil(threshold * len(s) - 1e-9) for s in self.sets]
        self.window = [SPREAD * int(n) for n in w.counts()]
        # Phrases are named by themselves and what may not follow them.
        self.deciding = [[[(phrase, after) for phrase, after in group.items()] for group in deciding.get(name, [])] for name in templates]
        self.phrases = Phrases({phrase: phrase for groups in self.deciding for group in groups for phrase, _ in group})

    def index(self, frequency: dict[int, int]) -> None:
        """Prefix index under the global order (frequency, token)."""
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.sets):
            order = sorted(words, key=lambda x: (frequency.get(x, 0), x))
            for place, token in enumerate(order[: len(order) - self.required[t] + 1]):
                self.prefix.setdefault(token, []).append((t, place))

    def candidates(self, tokens: set[int], n_words: int) -> list[int]:
        """Templates that could hold in a block with these tokens."""
        first: dict[int, int] = {}
        for token in tokens & self.prefix.keys():
            for t, place in self.prefix[token]:
                first[t] = min(place, first.get(t, place))
        return [t for t, place in first.items() if n_words >= self.required[t] <= len(self.sets[t]) - place and len(self.sets[t] & tokens) >= self.required[t]]

    def marks(self, w, hashes: np.ndarray, text: np.ndarray) -> dict[tuple[str, tuple], list[int]]:
        """The places of every deciding phrase, in order."""
        places: dict[str, list[int]] = {}
        for p, phrase in self.phrases.find(w, hashes, text):
            places.setdefault(phrase, []).append(p)
        out = {}
        for phrase, after in {x for groups in self.deciding for group in groups for x in group}:
            size, bad = len(phrase.split()), {x.encode() for x in after}
            out[phrase, after] = [p for p in places.get(phrase, []) if not (p + size < len(text) and text[p + size] == text[p] and w.word(p + size) in bad)]
        return out

    def share(self, t: int, words: list[tuple[int, int]], end: int, marks: dict) -> float:
        """The largest share of template t in any window, decided and before
        ``end``, of a block with these (place, token)."""

        def decided(a: int, z: int) -> bool:
            def inside(phrase: str, after: tuple) -> bool:
                at = marks[phrase, after]
                i = bisect_left(at, a)
                return i < len(at) and at[i] + len(phrase.split()) <= z

            return all(any(inside(*x) for x in group) for group in self.deciding[t])

        if not decided(words[0][0], end):
            return 0.0
        words = [x for x in words if x[1] in self.sets[t]]
        best, right = 0, 0
        seen: Counter = Counter()
        for a, token in words:
            z = min(a + self.window[t], end)
            while right < len(words) and words[right][0] < z:
                seen[words[right][1]] += 1
                right += 1
            if len(seen) > best and decided(a, z):
                best = len(seen)
            seen[token] -= 1
            if not seen[token]:
                del seen[token]
        return best / len(self.sets[t]) if best >= self.required[t] else 0.0


def _block_of(w) -> np.ndarray:
    """Number of the block of each word: a new one with each text and
    wherever two line ends stand between words."""
    if not len(w.starts):
        return np.empty(0, np.int64)
    lines = np.concatenate([[0], np.cumsum(w.data == 0x0A)])
    new = np.zeros(len(w.starts), bool)
    new[1:] = lines[w.starts[1:]] - lines[w.ends[:-1]] >= 2
    new[w.first[:-1][w.first[:-1] < len(new)]] = True
    return np.cumsum(new)


def _groups(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """(key, its values) over sorted keys."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    for part, group in zip(np.split(keys, edge), np.split(values, edge), strict=True):
        if len(part):
            yield int(part[0]), group.tolist()


def _count(templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                w = find_words(part.column("text"), ALNUM, True)
                at, token = templates.value.lexicon.find(w.hashes())
                pairs = np.unique(_block_of(w)[at] * len(templates.value.lexicon.known) + token)
                tokens, n = np.unique(pairs % len(templates.value.lexicon.known), return_counts=True)
                total.update(dict(zip(tokens.tolist(), n.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["token", "n"])

    return run


class Phrases:
    def __init__(self, phrases: dict[str, str] = PHRASES):
        w = _tokens(list(phrases))
        hashes = w.hashes()
        self.all = [(label, phrase.encode().split(), hashes[w.first[i]:w.first[i + 1]]) for i, (phrase, label) in enumerate(phrases.items())]

    def find(self, w, hashes: np.ndarray, text: np.ndarray) -> list[tuple[int, str]]:
        """(first word, label) of each place, verified word by word."""
        out = []
        for label, words, hashed in self.all:
            at = np.flatnonzero(hashes[: max(0, len(hashes) - len(words) + 1)] == hashed[0])
            for p in at:
                if text[p] == text[p + len(words) - 1] and all(w.word(p + j) == x for j, x in enumerate(words)):
                    out.append((int(p), label))
        return out


def _scan(templates, phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = find_words(part.column("text"), ALNUM, True)
                hashes, n = w.hashes(), part.num_rows
                text = np.repeat(np.arange(n), w.counts())
                places: list[list[tuple[int, str]]] = [[] for _ in range(n)]
                for p, label in phrases.value.find(w, hashes, text):
                    places[text[p]].append((p - int(w.first[text[p]]), label))
                blocks: list[list[dict]] = [[] for _ in range(n)]
                block = _block_of(w)
                at, token = templates.value.lexicon.find(hashes)
                marks = None
                for b, places_of in _groups(block[at], np.arange(len(at))):
                    tokens = set(token[places_of].tolist())
                    if not (tokens & templates.value.prefix.keys()):
                        continue
                    a, z = np.searchsorted(block, [b, b + 1])
                    candidates = templates.value.candidates(tokens, int(z - a))
                    if not candidates:
                        continue
                    if marks is None:
                        marks = templates.value.marks(w, hashes, text)
                    words = list(zip(at[places_of].tolist(), token[places_of].tolist(), strict=True))
                    for t in candidates:
                        share = templates.value.share(t, words, int(z), marks)
                        if share > 0:
                            first = int(w.first[text[a]])
                            blocks[text[a]].append({"label": templates.value.labels[t], "start": int(a) - first, "end": int(z) - first, "containment": share})
                base = [sorted({x for _, x in p}) for p in places]
                labels = [sorted({*x, *(y["label"] for y in z)}) for x, z in zip(base, blocks, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"), pa.array(w.counts(), pa.int64()), pa.array([len(p) for p in places], pa.int64()),
                        pa.array([min((x for x, _ in p), default=None) for p in places], pa.int64()), pa.array([max((x for x, _ in p), default=None) for p in places], pa.int64()),
                        pa.array([",".join(x) for x in base]), pa.array([",".join(x) for x in labels]),
                        pa.array([1.0 if p else max((y["containment"] for y in z), default=0.0) for p, z in zip(places, blocks, strict=True)], pa.float64()),
                        pa.array(blocks, pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("containment", pa.float64())]))),
                    ],
                    names=["key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"],
                )

    return run


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: words, places of base phrases (count, smallest
    and largest first word), labels, score (1 with a base phrase, else the
    best containment found, else 0) and ``blocks``: every block and template
    that meet the threshold, as word ranges."""
    spark = docs.sparkSession
    frames.ready(spark)
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    index = Templates(templates, threshold)
    counts = source.select("text").mapInArrow(_count(spark.sparkContext.broadcast(index)), "token bigint, n bigint")
    # At most one row per template word comes back.
    index.index({r.token: r.n for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()})
    run = _scan(spark.sparkContext.broadcast(index), spark.sparkContext.broadcast(Phrases(phrases)))
    schema = f"key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, blocks array<struct<label:string,start:int,end:int,containment:double>>"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(frames.read(spark, sf_dir, "documents"))
