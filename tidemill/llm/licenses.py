"""Operator 4: license scan by a positional index of rare license words.

Words are runs of digits, ASCII letters (lower-cased) and longer characters.  The index maps each word of the license
templates to (template, position).  Every place of a template's own rarest words (highest inverse document frequency, taken
from its mandatory key phrase) is looked up; the difference of file position and template position lines the template up
with the file, and differences that several rare words agree on are candidates.  A candidate becomes a label if enough of
the template's words stand at their places and its key phrase does too.  Since the whole key phrase must stand there, its
rarest words agree on every place that can become a label, however many other license words the file holds.  Base phrases
are counted at every place, whatever the method finds.

Cases: a null or empty text has no words and no labels; places may overlap; repeated rows get equal results; document
frequencies count every row, nulls too, and an empty table has none; extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.textbytes import repeat_index, span_hash, text_slices, words

# The base phrases with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices of public licenses: label, mandatory key phrase, text.
TEMPLATES = (
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3.0", "general public license version 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "general public license version 3", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "general public license version 2", "this program is licensed under the gnu general public license version 2"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0", "licensed under the creative commons attribution 4 0 international license"),
    ("bsd", "bsd license", "released under the bsd license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "all rights reserved", "copyright all rights reserved"),
)


@dataclass
class TemplateIndex:
    """Sorted word hashes with their postings; its size is that of the templates."""

    labels: list[str]
    texts: list[list[int]]
    keys: list[list[int]]
    vocabulary: np.ndarray
    base: list[list[int]]


def template_index(templates=TEMPLATES, base=BASE) -> TemplateIndex:
    hashed = lambda text: [span_hash(w.encode()) for w in text.split()]
    texts, keys, phrases = [hashed(t[2]) for t in templates], [hashed(t[1]) for t in templates], [hashed(p) for p, _ in base]
    vocabulary = np.unique(np.array([h for t in [*texts, *keys, *phrases] for h in t], np.uint64))
    return TemplateIndex([t[0] for t in templates], texts, keys, vocabulary, phrases)


def _known(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words in the vocabulary, and which they are."""
    places = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    found = np.flatnonzero(vocabulary[places] == hashes)
    return found, places[found]


def document_frequencies(docs: DataFrame, index: TemplateIndex) -> tuple[np.ndarray, int]:
    """How many rows hold each word of the index, over all rows, and the row count."""
    vocabulary = index.vocabulary

    def batches(stream):
        counts, rows = np.zeros(len(vocabulary), np.int64), 0
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                _, _, hashes, firsts = words(data, offsets)
                found, which = _known(hashes, vocabulary)
                pairs = np.unique(repeat_index(firsts)[found] * len(vocabulary) + which)
                counts += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
                rows += own.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(vocabulary))), pa.array(np.concatenate([[rows], counts]))], ["word", "n"])

    out, total = np.zeros(len(vocabulary), np.int64), 0
    for row in docs.select("text").mapInArrow(batches, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        if row.word < 0:
            total = int(row.n)
        else:
            out[row.word] = row.n
    return out, total


def _phrase_places(hashes: np.ndarray, of: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Word numbers at which the words of a phrase stand one after another in one text."""
    width = len(phrase)
    if len(hashes) < width:
        return np.empty(0, np.int64)
    at = np.flatnonzero(hashes[: len(hashes) - width + 1] == np.uint64(phrase[0]))
    for k in range(1, width):
        at = at[hashes[at + k] == np.uint64(phrase[k])]
    return at[of[at] == of[at + width - 1]]


class Aligner:
    """Looks up each template's rarest words in a file and lines the template up with it."""

    def __init__(self, index: TemplateIndex, idf: np.ndarray, rare: int, share: float, cover: float):
        self.index, self.cover = index, cover
        ranks = {int(h): k for k, h in enumerate(index.vocabulary)}
        self.texts = [[ranks[h] for h in t] for t in index.texts]
        self.keys = [[ranks[h] for h in t] for t in index.keys]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        #: a template is tried once half of its rarest words agree on where it begins
        self.need: list[int] = []
        #: the rarest word of each template: a file without it can't hold the key phrase
        self.first: list[int] = []
        for t, (text, key) in enumerate(zip(self.texts, self.keys)):
            chosen = sorted(set(key), key=lambda w: (-idf[w], w))[:rare]
            self.need.append(max(1, int(np.ceil(share * len(chosen)))))
            self.first.append(chosen[0])
            places = {q + k for q in range(len(text) - len(key) + 1) if text[q : q + len(key)] == key for k in range(len(key))}
            for p in sorted(places):
                if text[p] in chosen:
                    self.postings.setdefault(text[p], []).append((t, p))
        self.anchors = np.zeros(len(index.vocabulary), bool)
        self.anchors[self.first] = True

    def file(self, at: np.ndarray, which: np.ndarray) -> tuple[set[str], float]:
        """Labels and best coverage of one file, from the word numbers and vocabulary ranks of its license words."""
        place = dict(zip(at.tolist(), which.tolist()))
        present = set(place.values())
        able = [w in present for w in self.first]
        postings = {w: own for w in present if (own := [x for x in self.postings.get(w, ()) if able[x[0]]])}
        votes: dict[tuple[int, int], set[int]] = {}
        for p, w in place.items():
            for t, q in postings.get(w, ()):
                votes.setdefault((t, p - q), set()).add(w)
        labels, best = set(), 0.0
        for (t, begin), agreed in votes.items():
            if len(agreed) < self.need[t]:
                continue
            text = self.texts[t]
            cover = sum(place.get(begin + q) == w for q, w in enumerate(text)) / len(text)
            if cover >= self.cover and self._has_key(place, t, begin):
                labels.add(self.index.labels[t])
                best = max(best, cover)
        return labels, best

    def _has_key(self, place: dict[int, int], t: int, begin: int) -> bool:
        key, text = self.keys[t], self.texts[t]
        return any(text[q : q + len(key)] == key and all(place.get(begin + q + k) == w for k, w in enumerate(key)) for q in range(len(text) - len(key) + 1))


def scan_licenses(docs: DataFrame, *, templates=TEMPLATES, base=BASE, rare: int = 6, share: float = 0.5, cover: float = 0.7) -> DataFrame:
    """One row per document: word and place counts, base labels, all labels and a score.

    ``score`` is 1 with a base place, else the best coverage of a verified template, else 0.
    """
    index = template_index(templates, base)
    counts, total = document_frequencies(docs, index)
    idf = np.log((1 + total) / (1 + counts))
    names = [label for _, label in base]

    def batches(stream):
        aligner = Aligner(index, idf, rare, share, cover)
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                n = own.num_rows
                _, _, hashes, firsts = words(data, offsets)
                of = repeat_index(firsts)
                n_words = np.diff(firsts)
                n_base, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                labels: list[set[str]] = [set() for _ in range(n)]
                for phrase, label in zip(index.base, names):
                    at = _phrase_places(hashes, of, phrase)
                    d = of[at]
                    n_base += np.bincount(d, minlength=n)
                    np.minimum.at(first, d, at - firsts[d])
                    np.maximum.at(last, d, at - firsts[d])
                    for k in np.unique(d):
                        labels[k].add(label)
                base_labels = [",".join(sorted(x)) for x in labels]
                score = (n_base > 0).astype(float)
                at, which = _known(hashes, index.vocabulary)
                d = of[at]
                tried = np.unique(d[aligner.anchors[which]])
                lows, highs = np.searchsorted(d, tried), np.searchsorted(d, tried, "right")
                for k, low, high in zip(tried, lows, highs):
                    more, best = aligner.file(at[low:high] - firsts[k], which[low:high])
                    labels[k] |= more
                    score[k] = max(score[k], best)
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"), pa.array(n_words), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                        pa.array(base_labels, pa.string()), pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(score),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(batches, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


@query("op4_licenses")
def op4_licenses(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
