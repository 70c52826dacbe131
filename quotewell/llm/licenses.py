"""License scans with a positional index of rare licence words.

The index has, for every word of the templates, its postings (template, position). A word's rarity is its IDF over all documents. For
each file and template the highest-IDF words of the template that the file has are looked up, so that no notice takes another's place; every posting votes for a relative position (place in the file minus
place in the template), and where votes agree the template is laid over the file there: the share of its words that fit
within a small shift is its score. A template counts if the score reaches MIN_SCORE and its mandatory key phrases stand in the file around
that place. Only the index (the templates' words) and their IDF are sent to tasks; both are bounded by the templates.

Cases: a null or empty text has no words and no labels. Labels are distinct and sorted, however often a licence comes; none is the empty
string. Rows are judged alone, so ties and repeats need no rule. Very long texts are read whole. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, to_python


class Template(NamedTuple):
    label: str
    text: str
    key_phrases: tuple[str, ...]


#: Phrases and their labels.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Notices of public licences.
TEMPLATES = (
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0.", ("apache license",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0.", ("cc by nc",)),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3.", ("gnu general public license", "version 3")),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("gnu general public license", "version 3")),
    Template("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", ("gnu general public license", "version 2")),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3", ("gnu affero general public license",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", ("permission is hereby granted", "without restriction")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain.", ("free and unencumbered software",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ("creative commons attribution 4",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License.", ("creative commons attribution sharealike",)),
)

RARE_WORDS, MIN_SCORE, SHIFT = 24, 0.75, 2

#: A-Z lower-cased; other ASCII than digits and letters is a gap.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _spread(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase's words stand; joined and phrase are words between single blanks."""
    out, at, word, last = [], joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", last, at)
        out.append(word)
        last, at = at, joined.find(phrase, at + 1)
    return out


class LicenseIndex:
    """Postings and IDF of the templates' words."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float]) -> None:
        self.labels = [t.label for t in templates]
        self.words = [words_of(t.text.encode()) for t in templates]
        self.keys = [[_spread(words_of(p.encode())) for p in t.key_phrases] for t in templates]
        self.idf = idf
        self.ranked = [sorted(set(ws), key=lambda w: (-idf.get(w, 0.0), w)) for ws in self.words]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, ws in enumerate(self.words):
            for at, w in enumerate(ws):
                self.postings[w].append((t, at))

    def match(self, words: list[bytes]) -> dict[int, float]:
        """The best score of each template that has its key phrases."""
        have = set(words) & self.postings.keys()
        rare = [set([w for w in ranked if w in have][:RARE_WORDS]) for ranked in self.ranked]
        asked: dict[bytes, list[tuple[int, int]]] = {w: [(t, place) for t, place in self.postings[w] if w in rare[t]] for w in have}
        votes: Counter[tuple[int, int]] = Counter()
        for at, w in enumerate(words):
            for t, place in asked.get(w, ()):
                votes[t, at - place] += 1
        best: dict[int, float] = {}
        need = {t: max(2, math.ceil(MIN_SCORE / 2 * len(own))) for t, own in enumerate(rare)}
        for (t, start), n in votes.items():
            if n >= need[t] and (score := self._laid(words, t, start)) >= MIN_SCORE and score > best.get(t, 0.0):
                near = _spread(words[max(0, start - SHIFT) : max(0, start) + len(self.words[t]) + SHIFT])
                if all(k in near for k in self.keys[t]):
                    best[t] = score
        return best

    def _laid(self, words: list[bytes], t: int, start: int) -> float:
        own = self.words[t]
        return sum(w in words[max(0, start + k - SHIFT) : max(0, start + k + SHIFT + 1)] for k, w in enumerate(own)) / len(own)


def document_frequency(docs: DataFrame, vocabulary: set[bytes], *, text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Rows, and rows that hold each of the given words: a count for each word of the templates."""

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, Counter()
        for batch in batches:
            total += batch.num_rows
            for x in batch["text"]:
                if x.is_valid:
                    found.update(vocabulary.intersection(words_of(x.as_buffer().to_pybytes())))
        names = [b"", *found]
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in names]), pa.array([total, *found.values()], pa.int64())], ["word", "n"])

    rows = to_python(docs).select(F.col(text_col).cast("string").alias("text")).mapInArrow(counting, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r.word.encode(): r.n for r in rows}
    return counts.pop(b"", 0), counts


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per file: id, n_words, n_base, first_word, last_word, base_labels, labels, score (of the best template, 1 for a base phrase)."""
    vocabulary = {w for t in templates for w in words_of(t.text.encode())}
    total, counts = document_frequency(docs, vocabulary, text_col=text_col)
    index = LicenseIndex(templates, {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary})
    phrases = [(_spread(words_of(p.encode())), label) for p, label in BASE_PHRASES]

    def scanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(7)]
            for x in batch["text"]:
                row = scan_one(x.as_buffer().to_pybytes() if x.is_valid else b"", phrases, index)
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return to_python(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scanning, schema).withColumnRenamed("id", id_col)


def scan_one(text: bytes, phrases: list[tuple[bytes, str]], index: LicenseIndex) -> tuple:
    words = words_of(text)
    joined = _spread(words)
    places, base = [], set()
    for phrase, label in phrases:
        if at := phrase_places(joined, phrase):
            places += at
            base.add(label)
    fits = index.match(words)
    score = max([1.0 if base else 0.0, *fits.values()])
    labels = base | {index.labels[t] for t in fits}
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents."""
    return scan_licenses(load(spark, sf_dir, "documents"))
