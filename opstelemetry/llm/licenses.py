"""License scans with a generalised suffix automaton of licence templates.

The automaton accepts every run of words of every template. A text's words are streamed through it; at
each word it gives the matching statistic, the length of the longest run ending there that some template
holds. Words that no template has end every match, so only the stretches of template words of at least
two are streamed. Base phrases are read off the same states. Maximal matches of ``LEAST_MATCH`` words or
more are chained along a template, in order and with small gaps, into spans; a template whose chained
spans cover at least ``LEAST_COVER`` of its words gives its label.

Words are runs of letters, digits and bytes above 127, in lower case. Null and empty texts have none.
Repeated rows each get a row; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.llm import textbytes as B

#: The base phrases of the query's contract and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices that public licences ask authors to attach, and their labels.
TEMPLATES = (
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software",
    ),
    ("mit", "Released under the MIT License."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "This work is licensed under CC BY 4.0."),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
)
LEAST_MATCH = 4
LEAST_COVER = 0.6
MOST_GAP = 8


def split(text: bytes) -> tuple[list[bytes], np.ndarray]:
    data = B.LOWER[np.frombuffer(text, np.uint8)]
    raw = data.tobytes()
    low, high, _ = B.words(data, np.array([0, len(data)]), B.LOWER_ALNUM)
    return [raw[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)], low


class Automaton:
    """Suffix automaton of several word sequences, grown one word at a time."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: (sequence, place of its last word) of one end of each state's strings, by sequence.
        self.ends: list[dict[int, int]] = [{}]
        for i, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._add(last, word)
                at = last
                while at > 0 and i not in self.ends[at]:
                    self.ends[at][i] = place
                    at = self.link[at]

    def _new(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append({})
        return len(self.length) - 1

    def _copy(self, at: int, of: int, word: int) -> int:
        """A state for the shorter strings of ``of``, which all suffixes of ``at`` now lead to."""
        twin = self._new(self.length[at] + 1)
        self.next[twin] = dict(self.next[of])
        self.ends[twin] = dict(self.ends[of])
        self.link[twin], self.link[of] = self.link[of], twin
        while at >= 0 and self.next[at].get(word) == of:
            self.next[at][word] = twin
            at = self.link[at]
        return twin

    def _add(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._copy(last, known, word)
        new, at = self._new(self.length[last] + 1), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            of = self.next[at][word]
            self.link[new] = of if self.length[of] == self.length[at] + 1 else self._copy(at, of, word)
        return new

    def statistics(self, words: Sequence[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match that ends at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            else:
                length = 0
            yield state, length


class Scanner:
    """Automaton, word numbers and base phrases of a set of templates."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES):
        texts = [split(t.encode())[0] for _, t in templates] + [split(p.encode())[0] for p, _ in phrases]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(t) for t in texts[: len(templates)]]
        vocabulary = sorted({w for t in texts for w in t})
        self.number = {w: i for i, w in enumerate(vocabulary)}
        self.automaton = Automaton([[self.number[w] for w in t] for t in texts])
        joined = np.frombuffer(b" ".join(vocabulary), np.uint8)
        low, high, _ = B.words(joined, np.array([0, len(joined)]), B.NOT_SPACE)
        names = B.span_hash(B.prefix_hash(joined), low, high)
        self.order = np.argsort(names)
        self.names = names[self.order]
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in self.automaton.length]
        own = {}
        for phrase, label in phrases:
            words, state = split(phrase.encode())[0], 0
            for w in words:
                state = self.automaton.next[state][self.number[w]]
            own.setdefault(state, []).append((len(words), label))
        for state in range(1, len(self.phrases)):
            at = state
            while at > 0:
                self.phrases[state] += own.get(at, [])
                at = self.automaton.link[at]

    def numbers(self, names: np.ndarray) -> np.ndarray:
        """Word numbers by name; -1 for words of no template."""
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, self.order[at], -1)

    def scan(self, numbers: np.ndarray) -> dict:
        """Base places by label, and the chained spans of each template, of one text."""
        known = numbers >= 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        base: list[tuple[int, str]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for first, stop in edges.reshape(-1, 2).tolist():
            if stop - first < 2:
                continue
            before = (0, 0)
            for i, (state, length) in enumerate(self.automaton.statistics(numbers[first:stop].tolist()), first):
                base += [(i - n + 1, label) for n, label in self.phrases[state] if length >= n]
                if length <= before[1]:
                    self._keep(matches, i - 1, *before)
                before = (state, length)
            self._keep(matches, stop - 1, *before)
        return {"base": base, "spans": {t: chained(found) for t, found in matches.items()}}

    def _keep(self, matches: dict, at: int, state: int, length: int) -> None:
        """Note a match that cannot be longer: (first word, words, place in the template)."""
        if length >= LEAST_MATCH:
            for template, place in self.automaton.ends[state].items():
                if template < len(self.labels):
                    matches.setdefault(template, []).append((at - length + 1, length, place - length + 1))

    def covered(self, spans: Mapping[int, tuple[int, int, int]]) -> dict[str, float]:
        """Best share of a template's words under its spans, by label."""
        out: dict[str, float] = {}
        for template, (_, _, words) in spans.items():
            share = min(1.0, words / self.sizes[template])
            out[self.labels[template]] = max(out.get(self.labels[template], 0.0), share)
        return out

    def row(self, numbers: np.ndarray) -> tuple:
        """The values of a text's row, in the order of ``_NAMES``."""
        found = self.scan(numbers)
        base = found["base"]
        cover = self.covered(found["spans"])
        own = {label for label, share in cover.items() if share >= LEAST_COVER}
        base_labels = {label for _, label in base}
        places = [at for at, _ in base]
        spans = [
            {"label": self.labels[t], "first": a, "stop": b, "covered": n}
            for t, (a, b, n) in sorted(found["spans"].items())
            if n >= LEAST_COVER * self.sizes[t]
        ]
        return (
            len(numbers),
            len(base),
            min(places) if places else None,
            max(places) if places else None,
            ",".join(sorted(base_labels)),
            ",".join(sorted(base_labels | own)),
            1.0 if base else max(cover.values(), default=0.0),
            spans,
        )


def chained(matches: Sequence[tuple[int, int, int]]) -> tuple[int, int, int]:
    """(first word, word after the last, words covered) of the chain that covers most of a template.

    A chain goes on with a match that comes later in text and template, at most ``MOST_GAP`` words on.
    """
    best = (0, 0, 0)
    open_chains: list[tuple[int, int, int, int]] = []  # first, stop in text, stop in template, covered
    for first, length, place in sorted(matches):
        chain = (first, first + length, place + length, length)
        kept = []
        for f, stop, end, covered in open_chains:
            if first - stop > MOST_GAP:
                continue
            kept.append((f, stop, end, covered))
            cut = max(0, stop - first, end - place)
            if place + length > end and cut < length and place - end <= MOST_GAP and covered + length - cut > chain[3]:
                chain = (f, first + length, place + length, covered + length - cut)
        open_chains = [*kept, chain]
        if chain[3] > best[2]:
            best = (chain[0], chain[1], chain[3])
    return best


def scanned(docs: DataFrame, scanner: Scanner | None = None, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``score`` is the largest share of a template that the text covers, and 1 where a base phrase stands.
    ``spans`` are the chained template spans: label, first word, word after the last, words covered.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scanner or Scanner())
    kind = docs.schema[key].dataType.simpleString()
    span = "spans array<struct<label:string,first:bigint,stop:bigint,covered:bigint>>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Scanner = shared.value
        for batch in batches:
            for first, last, data, offsets in B.blocks(batch.column(1)):
                data = B.LOWER[data]
                low, high, at = B.words(data, offsets, B.LOWER_ALNUM)
                numbers = own.numbers(B.span_hash(B.prefix_hash(data), low, high))
                rows = [own.row(numbers[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_struct_array(
                    pa.StructArray.from_arrays(
                        [batch.column(0).slice(first, last - first), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES))],
                        ["__key", *_NAMES],
                    )
                )

    rows = docs.select(F.col(key).alias("__key"), F.col("text"))
    out = rows.mapInArrow(
        scan,
        f"__key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, {span}",
    )
    return out.withColumnRenamed("__key", key)


_NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
_TYPES = (
    *[pa.int64()] * 4,
    *[pa.string()] * 2,
    pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("stop", pa.int64()), ("covered", pa.int64())])),
)
