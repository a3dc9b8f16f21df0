"""Licence scans: matching statistics against a suffix automaton of licence texts."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from remitscope.llm.common import keyed_texts, text_batches

# Phrases whose every place counts, and the labels they give.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Well-known licence notices, and the labels they give.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
]

LEAST_MATCH = 3
LEAST_COVER = 0.7


def word_table() -> bytes:
    """Maps bytes: A-Z to lower case, other ASCII but digits and a-z to blanks."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for first, last in (b"09", b"az"):
        table[first : last + 1] = range(first, last + 1)
    for letter in range(ord("a"), ord("z") + 1):
        table[letter - 32] = letter
    return bytes(table)


TABLE = word_table()


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split()


class Match(NamedTuple):
    """Words [start, end) of a document that equal those of the template up to ``upto``."""

    start: int
    end: int
    template: int
    upto: int


class Automaton:
    """A suffix automaton of several word sequences, each fed from the root again.

    For each state: the length of its longest string, its suffix link, its moves, the places
    (template, end) where its strings end, and the phrases that end wherever its strings do.
    """

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.labels = [*phrases.values(), *(label for label, _ in templates)]
        texts = [words_of(text) for text in [*phrases, *(text for _, text in templates)]]
        self.lengths = [len(words) for words in texts]
        self.n_phrases = len(phrases)
        self.one_word = 1 in self.lengths[: self.n_phrases]
        self.ids: dict[bytes, int] = {}
        self.length, self.link, self.moves = [0], [-1], [{}]
        self.ends: list[set] = [set()]
        for t, words in enumerate(texts):
            last = 0
            for i, word in enumerate(words):
                last = self.extend(last, self.ids.setdefault(word, len(self.ids) + 1))
                self.ends[last].add((t, i + 1))
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        own: list[list[int]] = [[] for _ in self.length]
        for t in range(self.n_phrases):
            own[self.walk(texts[t])].append(t)
        self.ending: list[list[int]] = [[] for _ in self.length]
        for state in sorted(range(1, len(self.length)), key=lambda s: self.length[s]):
            self.ending[state] = self.ending[self.link[state]] + own[state]

    def walk(self, words: list[bytes]) -> int:
        state = 0
        for word in words:
            state = self.moves[state][self.ids[word]]
        return state

    def state(self, length: int, link: int, moves: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.moves.append(moves)
        self.ends.append(set())
        return len(self.length) - 1

    def split(self, state: int, token: int, target: int) -> int:
        """A copy of ``target`` for the strings that reach it from ``state`` and its suffixes."""
        copy = self.state(self.length[state] + 1, self.link[target], dict(self.moves[target]))
        while state >= 0 and self.moves[state].get(token) == target:
            self.moves[state][token] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def extend(self, last: int, token: int) -> int:
        known = self.moves[last].get(token)
        if known is not None:
            fits = self.length[known] == self.length[last] + 1
            return known if fits else self.split(last, token, known)
        new, state = self.state(self.length[last] + 1, 0, {}), last
        while state >= 0 and token not in self.moves[state]:
            self.moves[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.moves[state][token]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self.split(state, token, target)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[Match]]:
        """Places (start, phrase), and the matches of three words or more that go no further."""
        known = np.fromiter(map(self.ids.get, words, ZEROS), dtype=np.int32, count=len(words))
        places: list[tuple[int, int]] = []
        matches: list[Match] = []
        inside = np.flatnonzero(known)
        if not len(inside):
            return places, matches
        breaks = np.flatnonzero(np.diff(inside) > 1)
        firsts, lasts = inside[np.r_[0, breaks + 1]], inside[np.r_[breaks, len(inside) - 1]]
        for first, last in zip(firsts.tolist(), lasts.tolist()):
            if last > first or self.one_word:
                self.stream(known[first : last + 1].tolist(), first, places, matches)
        return places, matches

    def stream(self, tokens: list[int], offset: int, places: list, matches: list) -> None:
        """The matching statistics of one stretch of known words."""
        state = length = 0
        for i, token in enumerate(tokens):
            if length >= LEAST_MATCH and token not in self.moves[state]:
                self.report(state, length, offset + i, matches)
            while state and token not in self.moves[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.moves[state].get(token, 0)
            length = length + 1 if state else 0
            for t in self.ending[state]:
                if length >= self.lengths[t]:
                    places.append((offset + i + 1 - self.lengths[t], t))
        if length >= LEAST_MATCH:
            self.report(state, length, offset + len(tokens), matches)

    def report(self, state: int, length: int, end: int, matches: list) -> None:
        for t, upto in self.ends[state]:
            if upto >= length:
                matches.append(Match(end - length, end, t, upto))


class Zeros:
    """An endless supply of the default for words of no template."""

    def __iter__(self):
        return self

    def __next__(self) -> int:
        return 0


ZEROS = Zeros()


class Chain(NamedTuple):
    """Matches of a template that follow each other in both texts, and the words they cover there."""

    template: int
    start: int
    end: int
    covered: int
    pieces: tuple[tuple[int, int], ...]  # of the document, [start, end)


def added(before: Match, match: Match) -> int:
    """How many words a match adds behind an earlier one, in the document and in the template."""
    size = match.end - match.start
    return size - max(0, before.end - match.start, before.upto - (match.upto - size))


def chains_of(matches: list[Match], reach: int, least: float) -> list[Chain]:
    """Chains of a template that cover ``least`` words or more, best first, none over another's words.

    Matches come in order of their end. A match follows one that ends earlier in both texts, at most
    ``reach`` words before it begins; what overlaps counts once. For each match the chain up to it
    that covers most is worked out from those before it; of equal ones the one that begins later.
    """
    covered = [m.end - m.start for m in matches]
    starts = [m.start for m in matches]
    before = [-1] * len(matches)
    ends = [m.end for m in matches]
    for i, match in enumerate(matches):
        for j in range(bisect_left(ends, match.start - reach), i):
            other = matches[j]
            more = added(other, match)
            if more <= 0 or other.end >= match.end or other.upto >= match.upto:
                continue
            if (covered[j] + more, starts[j]) > (covered[i], starts[i]):
                covered[i], starts[i], before[i] = covered[j] + more, starts[j], j
    found: list[Chain] = []
    taken: list[tuple[int, int]] = []  # spans so far, in order
    for i in sorted(range(len(matches)), key=lambda i: (-covered[i], ends[i] - starts[i], ends[i])):
        if covered[i] < least:
            break
        at = bisect_left(taken, (starts[i], ends[i]))
        if at < len(taken) and taken[at][0] < ends[i] or at and taken[at - 1][1] > starts[i]:
            continue
        taken.insert(at, (starts[i], ends[i]))
        pieces, j = [], i
        while j >= 0:
            pieces.append((matches[j].start, matches[j].end))
            j = before[j]
        found.append(Chain(matches[i].template, starts[i], ends[i], covered[i], tuple(pieces[::-1])))
    return found


def chains(matches: list[Match], lengths: list[int]) -> list[Chain]:
    """For each template the chains that cover enough of it, none over another's words.

    What the best chains leave is searched again, as long as there are some.
    """
    by_template: dict[int, list[Match]] = {}
    for match in matches:
        by_template.setdefault(match.template, []).append(match)
    found = []
    for t, own in by_template.items():
        own.sort(key=lambda m: (m.end, m.start, m.upto))
        least = LEAST_COVER * lengths[t]
        while sum(m.end - m.start for m in own) >= least:
            new = chains_of(own, lengths[t], least)
            if not new:
                break
            found += new
            spans = sorted((c.start, c.end) for c in new)
            starts = [start for start, _ in spans]

            def is_free(m: Match) -> bool:
                at = bisect_left(starts, m.end)  # noqa: B023
                return not at or spans[at - 1][1] <= m.start  # noqa: B023

            own = [m for m in own if is_free(m)]
    return found


def told_apart(found: list[Chain], labels: list[str]) -> list[Chain]:
    """Without chains that say no more than one of another label.

    A chain whose words of the document are all in one of another label, which covers more, goes; two
    of different labels with the very same words both go, as nothing there tells which it is.
    """
    found = sorted(found, key=lambda chain: chain.start)
    words = [{w for start, end in chain.pieces for w in range(start, end)} for chain in found]
    vague = set()
    for i, chain in enumerate(found):
        for j in range(i + 1, len(found)):
            if found[j].start >= chain.end:
                break
            if labels[found[j].template] != labels[chain.template]:
                vague |= {a for a, b in ((i, j), (j, i)) if words[a] <= words[b]}
    return [chain for i, chain in enumerate(found) if i not in vague]


def chained(matches: list[Match], lengths: list[int], labels: list[str]) -> list[dict]:
    """Spans of words that cover a template, in order of their place."""
    spans = [
        {"label": labels[c.template], "start": c.start, "end": c.end, "cover": min(1.0, c.covered / lengths[c.template])}
        for c in told_apart(chains(matches, lengths), labels)
    ]
    return sorted(spans, key=lambda s: (s["start"], s["end"], s["label"], s["cover"]))


SPANS = pa.list_(
    pa.struct(
        [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]
    )
)
ROW = {
    "doc_id": pa.int64(),
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "spans": SPANS,
}


def examine(doc_id: int | None, text: str, automaton: Automaton) -> dict:
    words = words_of(text)
    places, matches = automaton.scan(words)
    spans = chained(matches, automaton.lengths, automaton.labels)
    base = {automaton.labels[t] for _, t in places}
    starts = [start for start, _ in places]
    return {
        "doc_id": doc_id,
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {span["label"] for span in spans})),
        "score": max([1.0 if base else 0.0, *(span["cover"] for span in spans)]),
        "spans": spans,
    }


def scanner(phrases: dict[str, str], templates: list[tuple[str, str]]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(phrases, templates)
        for ids, texts in text_batches(batches):
            rows = [examine(doc_id, text, automaton) for doc_id, text in zip(ids, texts)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(ROW.items())))

    return scan


def license_scan(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Places of phrases, and spans covered by licence templates, in every document.

    Words are runs of ASCII letters and digits, A-Z in lower case, and all other characters. A document
    is streamed through a suffix automaton of all phrases and templates; matches that go no
    further are chained by template: the chain that covers most of it in the order of both texts, with
    gaps of at most the template's length. One that covers 70 % of a template's words is a span with
    that template's label, unless its words are as well those of another label's span. The score is
    the best cover of a span, or 1 with a phrase.

    A very long text is streamed word by word; chains look back one template's length only. Null and empty texts have no words: counts of 0, null places, empty labels and a score of 0.
    Repeated rows give equal rows. Other columns are ignored. An empty table gives no rows.
    """
    spans = "array<struct<label: string, start: long, end: long, cover: double>>"
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        f"base_labels string, labels string, score double, spans {spans}"
    )
    scan = scanner(phrases or PHRASES, templates or TEMPLATES)
    return keyed_texts(docs).mapInArrow(scan, schema)
