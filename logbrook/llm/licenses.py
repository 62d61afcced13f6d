"""License notices in documents: winnowed fingerprints find candidates, a banded alignment measures them.

Texts and templates are read as words, lower-cased and without marks. Of the
hashes of ``GRAM`` words in a row, winnowing keeps the smallest of every
``WINDOW``; two texts that share ``GRAM + WINDOW - 1`` words in a row share a
kept hash. An inverted index from the templates' hashes to their places picks
what of a text to look at, and an alignment within ``BAND`` words of the diagonal tells how
much of the template is there and where. The index holds templates only, so its
size is fixed however many documents there are.

Defined results: null and empty texts have no matches and no rows. Every document
row is looked at on its own; extra columns are ignored. Matches of one template
in one document do not overlap; of equal ones the first counts.
"""

from __future__ import annotations

import bisect
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import Words, map_texts, mixed

GRAM, WINDOW, BAND = 3, 2, 6
COVERAGE = 0.75
"""The least part of a template's words that a match has."""

MATCH, MISMATCH, GAP = 2, -1, -1

# Notices by which texts are put under well-known licenses.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met"
    ),
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation"
    ),
}

SCHEMA = (
    "doc_id bigint, license string, start bigint, end bigint, matched_words bigint, template_words bigint, coverage double"
)
MARKS = re.compile(r"[\W_]+")


def _plain(word: str) -> str:
    return MARKS.sub("", word).lower()


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode())


def _grams(hashes: np.ndarray) -> np.ndarray:
    found = np.zeros(max(0, len(hashes) - GRAM + 1), np.uint64)
    for step in range(GRAM):
        found = mixed(found ^ hashes[step : len(hashes) - GRAM + 1 + step]) if len(found) else found
    return found


def winnowed(grams: np.ndarray) -> np.ndarray:
    """Places of the kept hashes: of each window the smallest, the last one of equal ones."""
    if not len(grams):
        return np.zeros(0, np.int64)
    width = min(WINDOW, len(grams))
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)
    return np.unique(np.arange(len(windows)) + width - 1 - windows[:, ::-1].argmin(axis=1))


class Index:
    """The templates' words and the places of their kept hashes."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = list(templates)
        self.words = [[plain for word in text.split() if (plain := _plain(word))] for text in templates.values()]
        self.hashes = [np.array([_hash(word) for word in words], np.uint64) for words in self.words]
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, hashes in enumerate(self.hashes):
            grams = _grams(hashes)
            for place in winnowed(grams).tolist():
                self.places[int(grams[place])].append((number, place))
        self.known = np.array(sorted(self.places), np.uint64)


def found(
    documents: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None
) -> DataFrame:
    """One row per match: the document, the license, where it stands in code points, and how much of it is there."""
    index = Index(templates or TEMPLATES)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = matches(index, batch.column(1))
        own = batch.column(0).take(pa.array([row[0] for row in rows], pa.int64()))
        columns = [pa.array(list(column)) for column in zip(*[row[1:] for row in rows])] or [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        columns = [pa.array(column, kind) if isinstance(column, list) else column.cast(kind) for column, kind in zip(columns, kinds)]
        names = ["doc_id", "license", "start", "end", "matched_words", "template_words", "coverage"]
        return pa.RecordBatch.from_arrays([own, *columns], names)

    return map_texts(documents.select(F.col(key).cast("bigint").alias("doc_id"), text), scan, SCHEMA, text)


def matches(index: Index, texts: pa.Array) -> list[tuple]:
    """(text, license, start, end, matched words, template words, coverage) of all matches in some texts."""
    words = Words(texts)
    plain = [_plain(word) for word in words.distinct.to_numpy(zero_copy_only=False).tolist()]
    hashes = np.array([_hash(word) for word in plain], np.uint64) if plain else np.zeros(0, np.uint64)
    wordy = np.array([bool(word) for word in plain], bool)[words.code] if plain else np.zeros(0, bool)
    place = np.flatnonzero(wordy)
    text, hashed = words.text[place], hashes[words.code[place]]
    grams = _grams(hashed)
    if not len(grams) or not len(index.known):
        return []
    # A gram or a window across two texts belongs to neither.
    kept = winnowed(grams)
    inside = text[: len(grams)] == text[GRAM - 1 :]
    hit = kept[np.isin(grams[kept], index.known) & inside[kept]]
    if WINDOW > 1:  # at the edge of a text a neighbour's hash may have taken a window
        edge = np.flatnonzero(inside & ~(np.append(inside[1:], False) & np.append(False, inside[:-1])))
        hit = np.union1d(hit, edge[np.isin(grams[edge], index.known)])
    found = []
    starts = np.searchsorted(text, np.arange(words.n_texts + 1))
    for owner in np.unique(text[hit]).tolist():
        begin, end = int(starts[owner]), int(starts[owner + 1])
        spans = None
        for number, first, last, matched in _aligned(index, hashed[begin:end], hit[text[hit] == owner] - begin, grams[begin:]):
            if spans is None:
                spans = _word_spans(texts[owner].as_py())
            size = len(index.words[number])
            found.append((owner, index.names[number], spans[first][0], spans[last][1], matched, size, matched / size))
    return found


def _word_spans(text: str) -> list[tuple[int, int]]:
    return [span.span() for span in re.finditer(r"[^\x20\x09-\x0D]+", text) if _plain(span[0])]


def _aligned(index: Index, text: np.ndarray, hits: np.ndarray, grams: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(template, first word, last word, matched words) of the matches around some hits."""
    lines: dict[int, list[int]] = defaultdict(list)
    for hit in hits.tolist():
        for number, place in index.places[int(grams[hit])]:
            lines[number].append(hit - place)
    found = []
    for number, diagonals in sorted(lines.items()):
        template = index.hashes[number]
        nowhere = next(value for value in range(len(template) + 1) if value not in set(template.tolist()))
        left, open_text = sorted(set(diagonals)), text.copy()
        # A diagonal's band reaches into the copy beside it. Words once matched are taken out and the rest aligned anew.
        while left:
            own = []
            for diagonal in left:
                low, high = max(0, diagonal - BAND), min(len(text), diagonal + len(template) + BAND)
                first, last, matched = banded(template, open_text[low:high], diagonal - low)
                if matched >= COVERAGE * len(template):
                    own.append((-matched, low + first, low + last, diagonal))
            taken: list[tuple[int, int]] = []
            for matched, first, last, _ in sorted(own):
                at = bisect.bisect_left(taken, (first, last))
                if (at == len(taken) or last < taken[at][0]) and (at == 0 or taken[at - 1][1] < first):
                    taken.insert(at, (first, last))
                    found.append((number, first, last, -matched))
                    open_text[first : last + 1] = nowhere
            left = sorted(diagonal for *_, diagonal in own)
    return sorted(found, key=lambda match: (match[1], match[0]))


def banded(template: np.ndarray, text: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """The best local alignment within ``BAND`` of a diagonal: first and last word of the text, and matched words."""
    width = 2 * BAND + 1
    empty = (0, -1, -1, 0)  # score, first, last, matched
    before = [empty] * (width + 2)
    best = empty
    for row in range(len(template)):
        line = [empty] * (width + 2)
        for step in range(1, width + 1):
            column = row + diagonal + step - 1 - BAND
            if not 0 <= column < len(text):
                continue
            score, first, last, matched = before[step]
            if template[row] == text[column]:
                taken = (score + MATCH, column if first < 0 else first, column, matched + 1)
            else:
                taken = (score + MISMATCH, first, last, matched)
            for other in (before[step + 1], line[step - 1]):
                if other[0] + GAP > taken[0]:
                    taken = (other[0] + GAP, *other[1:])
            line[step] = taken if taken[0] > 0 else empty
            if (line[step][0], line[step][3]) > (best[0], best[3]):
                best = line[step]
        before = line
    return best[1], best[2], best[3]
