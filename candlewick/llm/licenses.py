"""Licence scans: matching statistics from a generalised suffix automaton, chained into covered spans.

The automaton holds every run of words of every template and phrase. A text streams through it once:
after each word the state tells the longest run of words ending there that some template has. Longest
runs that cannot be prolonged are anchors; of each template, anchors in the same order in text and
template are chained, and a chain that covers enough of its template is a span. Of overlapping spans
the one that covers more words stays. A phrase stands wherever its own state is on the suffix path.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A null text has no words.
Every row gets a result of its own, whatever its doc_id; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.text import ship

#: Anchors have so many words (or the whole template); words between two of a chain; share of a template that a span covers.
ANCHOR, GAP, COVER = 4, 30, 0.75

#: Phrases that are counted, and the label of each.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of public licences and of the notices that refer to them.
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "SPDX License Identifier MIT"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "SPDX License Identifier Apache 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    (
        "bsd-3-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS "
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
        "FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0"),
    ("cc-by-nd-4.0", "licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa-4.0", "licensed under CC BY-NC-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]

# Digits, letters and all bytes of other characters stand; A-Z are lower-cased; the rest are spaces.
_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Automaton:
    """All runs of words of several texts: one state for the runs that end at the same places."""

    def __init__(self, texts: Sequence[Sequence[bytes]]):
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: (text, index of the last word) of the runs of a state
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, text in enumerate(texts):
            last = 0
            for at, word in enumerate(text):
                last = self._extend(last, self.words.setdefault(word, len(self.words) + 1))
                self.ends[last].append((number, at))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]].extend(self.ends[state])

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state of exactly ``parent`` and the word: the present one, or a copy for its shorter runs."""
        state = self.next[parent][word]
        if self.length[state] == self.length[parent] + 1:
            return state
        copy = self._state(self.length[parent] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = copy
        while parent >= 0 and self.next[parent].get(word) == state:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        state = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word)
        return state

    def statistics(self, words: Sequence[int], state: int = 0, length: int = 0) -> Iterator[tuple[int, int]]:
        """After each word, the state and length of the longest run ending there; 0 is an unknown word."""
        follow, link, longest = self.next, self.link, self.length
        for word in words:
            to = follow[state].get(word)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = follow[state].get(word)
            state, length = (0, 0) if to is None else (to, length + 1)
            yield state, length


@dataclass(frozen=True)
class Span:
    label: str
    first: int
    last: int
    covered: int
    share: float


class Scanner:
    """Places of phrases and spans of templates in texts."""

    def __init__(self, templates: Sequence[tuple[str, str]] = tuple(TEMPLATES), phrases: Mapping[str, str] = PHRASES):
        named = [*phrases.items(), *((text, label) for label, text in templates)]
        texts = [words_of(text.encode()) for text, _ in named]
        self.labels, self.sizes = [label for _, label in named], [len(text) for text in texts]
        self.automaton = auto = Automaton(texts)
        #: Phrases on a state's suffix path, and the ends that may anchor a chain.
        self.phrases: list[tuple[int, ...]] = [()] * len(auto.link)
        self.anchors: list[list[tuple[int, int]]] = []
        own: dict[int, int] = {}
        for number in range(len(phrases)):
            for state, _ in auto.statistics([auto.words[w] for w in texts[number]]):
                pass
            own[number] = state
        for state in sorted(range(len(auto.link)), key=auto.length.__getitem__):
            above = self.phrases[auto.link[state]] if state else ()
            self.phrases[state] = above + tuple(n for n, at in own.items() if at == state)
        for state, ends in enumerate(auto.ends):
            long = auto.length[state]
            self.anchors.append([(t, e) for t, e in ends if t >= len(phrases) and long >= min(ANCHOR, self.sizes[t])])

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[str, int, int]], list[Span]]:
        """Number of words, places (label, first and last word) of phrases, and spans of templates."""
        words = words_of(text or b"")
        ids = np.fromiter((self.automaton.words.get(w, 0) for w in words), np.int32, len(words))
        known = np.flatnonzero(ids)
        breaks = np.flatnonzero(np.diff(known) > 1) + 1
        places: list[tuple[str, int, int]] = []
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        for run in np.split(known, breaks) if len(known) else ():
            if len(run) > 1:
                self._run(ids[run].tolist(), int(run[0]), places, anchors)
        return len(words), places, self._spans(anchors)

    def _run(self, ids: list[int], start: int, places: list, anchors: dict[int, list[tuple[int, int, int]]]) -> None:
        held = (0, 0)
        for at, (state, length) in enumerate(self.automaton.statistics([*ids, 0]), start):
            if length != held[1] + 1 and self.anchors[held[0]]:  # cannot be prolonged
                for template, end in self.anchors[held[0]]:
                    if held[1] >= min(ANCHOR, self.sizes[template]):
                        anchors.setdefault(template, []).append((at - held[1], end - held[1] + 1, held[1]))
            for phrase in self.phrases[state]:
                if length >= self.sizes[phrase]:
                    places.append((self.labels[phrase], at - self.sizes[phrase] + 1, at))
            held = (state, length)

    def _spans(self, anchors: dict[int, list[tuple[int, int, int]]]) -> list[Span]:
        chains = [span for template, found in anchors.items() for span in self._chains(template, found)]
        chains.sort(key=lambda s: (-s.covered, -s.share, s.first, s.last, s.label))
        taken: list[tuple[int, int]] = []
        kept = []
        for span in chains:
            at = bisect_left(taken, (span.first, span.last))
            if (at == len(taken) or taken[at][0] > span.last) and (not at or taken[at - 1][1] < span.first):
                taken.insert(at, (span.first, span.last))
                kept.append(span)
        return sorted(kept, key=lambda s: s.first)

    def _chains(self, template: int, found: list[tuple[int, int, int]]) -> Iterator[Span]:
        """For each anchor the chain that ends there and covers most, if that is enough of the template."""
        found.sort(key=lambda a: (a[0] + a[2], a[1] + a[2]))
        best: list[tuple[int, int]] = []  # words covered, first word
        recent = 0
        for j, (start, at, size) in enumerate(found):
            covered, first = size, start
            while found[recent][0] + found[recent][2] + GAP < start:
                recent += 1
            for i in range(recent, j):
                before, own, length = found[i]
                overlap = max(0, before + length - start, own + length - at)
                if before < start and own < at and overlap < size and at - own - length <= GAP and best[i][0] + size - overlap > covered:
                    covered, first = best[i][0] + size - overlap, best[i][1]
            best.append((covered, first))
            if covered >= COVER * self.sizes[template]:
                yield Span(self.labels[template], first, start + size - 1, covered, covered / self.sizes[template])


_SCAN = (
    "n_words long, places array<struct<label string, first long, last long>>, "
    "spans array<struct<label string, first long, last long, covered long, share double>>"
)


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = tuple(TEMPLATES), phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, places of phrases and spans of templates, by words counted from 0."""
    ship(docs.sparkSession)
    kinds = T.StructType([docs.schema["doc_id"], *T.DataType.fromDDL(_SCAN).fields])
    templates, phrases = list(templates), dict(phrases)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        scanner, schema = Scanner(templates, phrases), to_arrow_schema(kinds)
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            rows = [scanner.scan(text.as_py()) for text in texts]
            words = pa.array([n for n, _, _ in rows], pa.int64())
            places = pa.array([[dict(zip(("label", "first", "last"), p, strict=True)) for p in found] for _, found, _ in rows], schema.field("places").type)
            spans = pa.array([[vars(s) for s in found] for _, _, found in rows], schema.field("spans").type)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], words, places, spans], schema=schema)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(read, kinds)


def summary(scanned: DataFrame) -> DataFrame:
    """A row per scanned row: counts, first and last place of a phrase, labels and the largest share of a template covered.

    A phrase that stands counts as covered wholly; without phrases and spans the score is 0 and the labels are empty.
    """
    names = lambda *columns: F.array_join(F.array_sort(F.array_distinct(F.concat(*[c["label"] for c in columns]))), ",")
    places, spans = F.col("places"), F.col("spans")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places["first"]).alias("first_word"),
        F.array_max(places["first"]).alias("last_word"),
        names(places).alias("base_labels"),
        names(places, spans).alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce(F.array_max(spans["share"]), F.lit(0.0))).alias("score"),
        F.size(spans).cast("long").alias("n_spans"),
    )
