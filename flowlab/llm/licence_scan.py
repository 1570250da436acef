"""Licence scans by a positional index of rare licence words.

Method: each template's words have postings (template, place), kept for its rarest words by
inverse document frequency, counted over all documents scanned. A file's occurrences of
those words are looked up; each posting gives the place where the template would start, and
postings of one template that agree on it, to within a few words, are one candidate. The
share of the template's rare words that agree must reach the limit, and then the template's
mandatory phrases are looked for in the words at that place, which decides.

The templates are a fixed list, so the index has a fixed size; it is sent to the executors.
Texts are read twice: once to count in how many documents each licence word stands (one
small sum per word), once to scan. Nothing else is shuffled.

Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII.

Cases: a null or wordless text has no places, no labels and score 0. Repeated rows are each
scanned. An empty table gives an empty result. Other columns aren't looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import text_of
from flowlab.llm.shingles import slices

# Phrases that count wherever they stand, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Fixed values: (label, notice in the licence's own words, mandatory phrases).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    ("gpl", "licensed under the GNU General Public License, version 3", ["gnu general public license"]),
    ("lgpl", "licensed under the GNU Lesser General Public License, version 3", ["lesser general public license"]),
    ("agpl", "licensed under the GNU Affero General Public License, version 3", ["affero general public license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met",
     ["redistribution and use in source and binary forms", "conditions are met"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted", ["for any purpose with or without fee is hereby granted"]),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["mozilla public license"]),
    ("cc-by", "Licensed under CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", ["cc by nd"]),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal", ["cc0 1 0"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]

RARE_WORDS = 6     # of a template that are indexed, the rarest by all documents
MIN_SHARE = 0.6    # of a template's indexed words that must agree on a place
DRIFT = 3          # words by which agreeing postings may differ

_WORDS = re.compile("[0-9a-z\x80-\U0010FFFF]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_in(text: str) -> list[str]:
    return _WORDS.findall(text.translate(_UPPER))


def places(words: list[str], phrase: list[str]) -> list[int]:
    """Where the phrase's words stand consecutively."""
    out, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at:at + len(phrase)] == phrase:
            out.append(at)


class Index:
    """Postings of each template's rarest words; `idf` by word."""

    def __init__(self, templates, idf: dict[str, float]):
        self.templates, self.postings = [], {}
        for n, (label, text, phrases) in enumerate(templates):
            words = words_in(text)
            rare = sorted(dict.fromkeys(words), key=lambda w: (-idf.get(w, 0.0), words.index(w)))[:RARE_WORDS]
            self.templates.append((label, len(words), len(rare), [p.split(" ") for p in phrases]))
            for word in rare:
                for at, w in enumerate(words):
                    if w == word:
                        self.postings.setdefault(word, []).append((n, at))
        self.words = frozenset(self.postings)

    def scan(self, words: list[str]) -> dict[str, float]:
        """Label to the best share of its template's rare words, for labels that are confirmed."""
        starts: dict[int, list[tuple[int, str]]] = {}
        for place, word in enumerate(words):
            for n, at in self.postings.get(word, ()):
                starts.setdefault(n, []).append((place - at, word))
        out: dict[str, float] = {}
        for n, found in starts.items():
            label, length, rare, phrases = self.templates[n]
            found.sort()
            first = 0
            agreeing: dict[str, int] = {}
            for start, word in found:
                agreeing[word] = agreeing.get(word, 0) + 1
                while found[first][0] < start - DRIFT:
                    gone = found[first][1]
                    agreeing[gone] -= 1
                    if not agreeing[gone]:
                        del agreeing[gone]
                    first += 1
                share = len(agreeing) / rare
                if share >= MIN_SHARE and share > out.get(label, 0.0):
                    low = max(found[first][0] - DRIFT, 0)
                    near = words[low:start + length + DRIFT]
                    if all(places(near, p) for p in phrases):
                        out[label] = share
        return out


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, text, _ in templates for w in words_in(text)})


def _frequencies(vocabulary: list[str]):
    wanted = frozenset(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        documents = 0
        for batch in batches:
            for _, part in slices(batch.column(0)):
                documents += len(part)
                for text in part.to_pylist():
                    for word in wanted.intersection(words_in(text)):
                        seen[word] = seen.get(word, 0) + 1
        seen[""] = documents
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    return run


def inverse_frequencies(texts: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """log(documents / documents with the word) of every template word, over all texts."""
    vocabulary = _vocabulary(templates)
    counts = dict(map(tuple, texts.mapInArrow(_frequencies(vocabulary), "word string, n long")
                      .groupBy("word").agg(F.sum("n").alias("n")).collect()))
    total = counts.get("", 0) + 1
    return {w: math.log(total / (counts.get(w, 0) + 1)) for w in vocabulary}


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")


def _scanner(sent, phrases: dict[str, str]):
    split = [(p.split(" "), label) for p, label in phrases.items()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            rows = []
            for _, part in slices(batch.column(1)):
                for text in part.to_pylist():
                    words = words_in(text)
                    present = set(words)
                    starts, base = [], set()
                    for phrase, label in split:
                        if present.issuperset(phrase) and (found := places(words, phrase)):
                            starts += found
                            base.add(label)
                    scores = index.scan(words) if present & index.words else {}
                    rows.append((
                        len(words), len(starts), min(starts, default=None), max(starts, default=None),
                        ",".join(sorted(base)), ",".join(sorted(base | set(scores))),
                        max([*scores.values(), 1.0 if base else 0.0])))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pc.cast(batch.column(0), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  templates=TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word (of the
    phrases' places), base_labels, labels (with those of the templates), and score, the
    largest share of a confirmed template's rare words that agree (1 for a phrase)."""
    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    index = Index(templates, inverse_frequencies(rows.select("text"), templates))
    sent = docs.sparkSession.sparkContext.broadcast(index)
    return rows.mapInArrow(_scanner(sent, phrases), SCHEMA)
