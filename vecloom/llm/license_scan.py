"""Licence scanning with a generalised suffix automaton.

All templates (licence texts, notices and the fixed phrases) go into one automaton over their words. Files are streamed
through it, which gives the matching statistics: for every word the longest match with any template that ends there, and by the
suffix links the shorter ones with other templates. Matches of ``SEED`` words or more that cannot be extended to the right are
anchors; anchors of one template in the same order in file and template, at most ``GAP`` words apart, are chained, and
a chain that covers a share of at least ``COVER`` of its template's words is a span. A fixed phrase is found where the automaton's state has it as
a suffix.

A match of two or more words only holds pairs of words that follow each other in a template. numpy marks those pairs over whole
texts, by fingerprints; only their runs are walked word by word, on the words' bytes. Elsewhere a statistic is 1 or 0.

The automaton is bounded by the templates, never by the input. It travels with the function; no row is shuffled.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows are scanned each on their own; a text of
any length is scanned whole; further columns are ignored. The score is 1 where a phrase stands, else the largest covered share
of the spans, else 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm import words as W

SEED = 4
GAP = 12
COVER = 0.8

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public wordings of licences and notices, by SPDX identifier in lower case.
TEMPLATES = {
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "gpl-2.0": ["licensed under the GNU General Public License, version 2", "under the terms of the GNU General Public License version 2"],
    "gpl-3.0": [
        "licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "cc-by-4.0": ["licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4.0": ["licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc-4.0": ["licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software.",
    ],
}


def words_of(text: str) -> list[bytes]:
    raw = W.LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = W.split_words(raw, np.array([0, len(raw)]), W.ALNUM)
    return [raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class SuffixAutomaton:
    """The smallest automaton of all substrings of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: list[list[tuple[int, int]]] = [[]]
        self.whole: list[int] = []  # the state of each sequence
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word, ends)
                ends[last].append((number, at))
            self.whole.append(last)
        self.ends: list[list[tuple[int, int]]] = [list(e) for e in ends]  # where the strings of a state end
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] += self.ends[state]

    def _extend(self, last: int, word: int, ends: list) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known, ends)
        state = self._state(self.length[last] + 1, {}, -1, ends)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last < 0:
            self.link[state] = 0
        else:
            known = self.next[last][word]
            self.link[state] = known if self.length[known] == self.length[last] + 1 else self._split(last, word, known, ends)
        return state

    def _split(self, last: int, word: int, known: int, ends: list) -> int:
        state = self._state(self.length[last] + 1, dict(self.next[known]), self.link[known], ends)
        self.link[known] = state
        while last >= 0 and self.next[last].get(word) == known:
            self.next[last][word] = state
            last = self.link[last]
        return state

    def _state(self, length: int, following: dict[int, int], link: int, ends: list) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        ends.append([])
        return len(self.link) - 1

    def statistics(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """Per word the state and the length of the longest match that ends with it."""
        state = length = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            following = self.next[state].get(word)
            if following is None:
                state = length = 0
            else:
                state, length = following, length + 1
            yield state, length


class Templates:
    """The automaton of phrases and templates, and what finds the places where it has to be walked."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, list[str]]):
        texts = [(label, words_of(text)) for text, label in phrases.items()]
        self.phrases = len(texts)
        texts += [(label, words_of(text)) for label, wordings in templates.items() for text in wordings]
        if any(len(w) < 2 for _, w in texts):
            raise ValueError("a phrase or template needs two words or more")
        self.labels = [label for label, _ in texts]
        vocabulary = sorted({w for _, sequence in texts for w in sequence})
        self.number = {w: i for i, w in enumerate(vocabulary)}
        self.sequences = [[self.number[w] for w in sequence] for _, sequence in texts]
        self.automaton = SuffixAutomaton(self.sequences)
        raw = np.frombuffer(b"".join(vocabulary), np.uint8)
        stops = np.cumsum([len(w) for w in vocabulary])
        codes = W.fingerprints(raw, stops - [len(w) for w in vocabulary], stops)
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        self.follows = np.zeros((len(vocabulary), len(vocabulary)), bool)
        for sequence in self.sequences:
            self.follows[sequence[:-1], sequence[1:]] = True
        self.phrase_of = self._phrases_of_states()

    def _phrases_of_states(self) -> list[list[int]]:
        """Per state the phrases that are suffixes of its strings, if the strings are as long."""
        own: dict[int, list[int]] = {}
        for phrase in range(self.phrases):
            own.setdefault(self.automaton.whole[phrase], []).append(phrase)
        out: list[list[int]] = [[] for _ in self.automaton.link]
        for state in sorted(range(1, len(out)), key=self.automaton.length.__getitem__):
            out[state] = own.get(state, []) + out[self.automaton.link[state]]
        return out

    def runs(self, codes: np.ndarray, row_of: np.ndarray) -> Iterator[tuple[int, int]]:
        """First and last word of the runs in which every two words follow each other in a template."""
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[place] == codes
        number = self.order[place]
        pair = known[:-1] & known[1:] & (row_of[:-1] == row_of[1:])
        at = np.flatnonzero(pair)
        at = at[self.follows[number[at], number[at + 1]]]
        if len(at):
            breaks = np.flatnonzero(np.diff(at) > 1)
            yield from zip(at[np.concatenate([[0], breaks + 1])].tolist(), (at[np.append(breaks, len(at) - 1)] + 1).tolist(), strict=True)

    def anchors(self, state: int, length: int, following: int | None, seed: int) -> Iterator[tuple[int, int, int]]:
        """Template, end and length of the matches that end here and cannot be extended by the word that follows."""
        seen = set()
        while state > 0 and length >= seed:
            for template, end in self.automaton.ends[state]:
                if template >= self.phrases and (template, end) not in seen:
                    seen.add((template, end))
                    sequence = self.sequences[template]
                    if end + 1 == len(sequence) or sequence[end + 1] != following:
                        yield template, end, length
            state = self.automaton.link[state]
            length = self.automaton.length[state]


def chains(anchors: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """First word, last word and covered words of the best chains of one template's anchors (file end, template end, length).

    Anchors follow each other if both ends grow and the file has at most ``gap`` words between them; where they overlap,
    only what is new counts. Only anchors within reach are compared.
    """
    anchors = sorted(anchors)
    best: list[tuple[int, int]] = []  # covered words, first word
    followed = [False] * len(anchors)
    oldest = 0
    for j, (end, t_end, length) in enumerate(anchors):
        while oldest < j and end - length - anchors[oldest][0] > gap:
            oldest += 1
        top, source = (length, end - length + 1), -1
        for k in range(oldest, j):
            k_end, k_t_end, _ = anchors[k]
            new = min(length, end - k_end, t_end - k_t_end)
            if new > 0 and best[k][0] + new > top[0] and end - length - k_end <= gap:
                top, source = (best[k][0] + new, best[k][1]), k
        best.append(top)
        if source >= 0:
            followed[source] = True
    ends = sorted(((best[j][0], -best[j][1], anchors[j][0]) for j in range(len(anchors)) if not followed[j]), reverse=True)
    return [(-first, last, covered) for covered, first, last in ends]


def _without_overlap(spans: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The spans of a label; of those that meet, the longer one."""
    kept: list[tuple[int, int, float]] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1], -s[2])):
        if not kept or span[0] > kept[-1][1]:
            kept.append(span)
        elif span[1] - span[0] > kept[-1][1] - kept[-1][0]:
            kept[-1] = span
    return kept


def _without_weaker(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """The spans of a row without those inside a span of another label with a larger share, as other versions of a notice are."""
    kept: list[tuple[str, int, int, float]] = []
    around: list[tuple[str, int, int, float]] = []  # one per label at most, as those of a label don't overlap
    for span in sorted(spans, key=lambda s: (s[1], -s[2], -s[3], s[0])):
        around = [s for s in around if s[2] >= span[1]]
        if not any(s[2] >= span[2] and s[3] > span[3] for s in around):
            kept.append(span)
        around.append(span)
    return kept


def scan_words(
    templates: Templates, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray, row_of: np.ndarray, seed: int, gap: int, cover: float
) -> tuple[dict[int, list], dict[int, list]]:
    """Per row the places of phrases (word, phrase) and the spans (label, first word, last word, share), words counted over all rows."""
    places: dict[int, list] = {}
    anchors: dict[tuple[int, int], list] = {}
    for first, last in templates.runs(codes, row_of):
        row = int(row_of[first])
        numbers = [templates.number.get(raw[starts[k] : ends[k]].tobytes(), -1) for k in range(first, last + 1)]
        for k, (state, length) in enumerate(templates.automaton.statistics(numbers)):
            if length < 2:
                continue
            for phrase in templates.phrase_of[state]:
                size = len(templates.sequences[phrase])
                if length >= size:
                    places.setdefault(row, []).append((first + k - size + 1, phrase))
            if length >= seed:
                following = numbers[k + 1] if k + 1 < len(numbers) else None
                for template, end, size in templates.anchors(state, length, following, seed):
                    anchors.setdefault((row, template), []).append((first + k, end, size))
    found: dict[tuple[int, str], list] = {}
    for (row, template), matches in anchors.items():
        size = len(templates.sequences[template])
        for first, last, covered in chains(matches, gap):
            if covered >= cover * size:
                found.setdefault((row, templates.labels[template]), []).append((first, last, covered / size))
    spans: dict[int, list] = {}
    for (row, label), parts in found.items():
        spans.setdefault(row, []).extend((label, *span) for span in _without_overlap(parts))
    return places, {row: _without_weaker(several) for row, several in spans.items()}


def scan(
    docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None, seed: int = SEED, gap: int = GAP, cover: float = COVER
) -> DataFrame:
    """Per row: doc_id, n_words, phrases (word, label) and spans (label, first, last, share), both in the order of words from 0."""
    known = Templates(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    place = T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())])
    span = T.StructType([
        T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("share", T.DoubleType()),
    ])
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("phrases", T.ArrayType(place)), T.StructField("spans", T.ArrayType(span)),
    ])
    places_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    spans_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_bytes(batch.column(1))
            for a, b in W.row_slices(offsets):
                raw = W.LOWER[data[offsets[a] : offsets[b]]]
                starts, ends, words = W.split_words(raw, offsets[a : b + 1] - offsets[a], W.ALNUM)
                row_of, _ = W.spans(np.diff(words))
                places, spans = scan_words(known, raw, starts, ends, W.fingerprints(raw, starts, ends), row_of, seed, gap, cover)
                begin = words.tolist()
                found = [[{"word": w - begin[r], "label": known.labels[p]} for w, p in sorted(places.get(r, []))] for r in range(b - a)]
                covered = [
                    [
                        {"label": label, "first": first - begin[r], "last": last - begin[r], "share": share}
                        for label, first, last, share in sorted(spans.get(r, []), key=lambda s: (s[1], s[2], s[0]))
                    ]
                    for r in range(b - a)
                ]
                columns = [batch.column(0).slice(a, b - a), pa.array(np.diff(words)), pa.array(found, places_type), pa.array(covered, spans_type)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op11_suffix_automaton_licenses(spark, sf_dir):
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    share = F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("spans.share"), F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("bigint").alias("n_base"), F.array_min("phrases.word").alias("first_word"),
        F.array_max("phrases.word").alias("last_word"), joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat("phrases.label", "spans.label")).alias("labels"), share.alias("score"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first"], s["last"])), ",").alias("spans"),
    )
