"""Licence scan: matching statistics of a generalised suffix automaton, chained into covered template spans.

The automaton holds every run of words of every licence template. A text streams through it: after each word the state
tells the longest run of words ending there that any template contains, and in which templates at which places. Runs of
at least ``RUN`` words that cannot be prolonged are matches. Matches of one template that follow each other in the text
and in the template are chained, the chain with the most words first; a chain that covers at least the share ``COVER`` of its
template is a span with the template's label. Templates are short, so windows three times as long as a template,
each one template further, hold every chain of interest and keep the work in proportion to the matches.

Only stretches of four words that some template contains reach the automaton; they are found in arrays of exact word
numbers. Besides, all places of three fixed phrases are listed; their labels stay whatever the chains say.

Words are lower-cased (A-Z) runs of letters, digits and signs outside ASCII. Null and empty texts have no words and the
score 0. Texts and words of any length are taken whole. Spans of one label that lie within a better one are dropped; of
equally long chains the first stays. Rows are independent: repeated rows give equal results, ids may be null. Empty tables give no
rows; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.llm.texts import _offsets, finished, slices, texts_array

#: Phrases whose places are listed, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: The public wording of common licences and of the notices that name them.
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
        later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for
        more details."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED."""),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
        "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
)

#: Words of the shortest match, and the share of a template that a span covers.
RUN, COVER = 4, 0.8
#: Score of a text that only names a licence by one of the phrases.
NAMED = 0.5

SCANNED = (
    "doc_id long, n_words long, places array<struct<phrase:int,at:long>>, "
    "spans array<struct<label:string,template:int,start:long,end:long,covered:long,share:double>>, best_share double"
)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_INSIDE = np.ones(256, dtype=bool)
_INSIDE[:128] = [chr(k).isalnum() for k in range(128)]


def template_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


class Automaton:
    """Generalised suffix automaton: the states, and for each the (template, end) of all its occurrences."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for t, words in enumerate(templates):
            last = 0
            for at, word in enumerate(words, 1):
                last = self._extended(last, word)
                self.ends[last].add((t, at))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, state: int, word: int) -> int:
        """The state that is reached by the word and holds no longer runs than one more than the state's."""
        old = self.next[state][word]
        if self.length[old] == self.length[state] + 1:
            return old
        new = self._state(self.length[state] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = new
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]
        return new

    def _extended(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def matches(self, words: list[int], shortest: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of the runs of words in some template that the next word does not prolong."""
        state = length = 0
        for at, word in enumerate(words):
            before, size = state, length
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                length = 0
            if length <= size and size >= shortest:
                yield at, size, before
        if length >= shortest:
            yield len(words), length, state


Match = tuple[int, int, int, int]  # start and end in the text, start and end in the template


def best_chain(matches: list[Match], size: int) -> list[Match]:
    """The matches, in order in text and template and without overlap, that cover most words; matches rise by start."""
    tree = [(0, -1)] * (size + 1)  # prefix maxima over ends in the template

    def highest(at: int) -> tuple[int, int]:
        out = (0, -1)
        while at > 0:
            out = max(out, tree[at])
            at -= at & -at
        return out

    scores, back = [], []
    waiting = sorted(range(len(matches)), key=lambda k: matches[k][1])
    done = 0
    for start, end, low, high in matches:
        while done < len(waiting) and matches[waiting[done]][1] <= start:
            k = waiting[done]
            at = matches[k][3]
            while at <= size:
                tree[at] = max(tree[at], (scores[k], k))
                at += at & -at
            done += 1
        score, k = highest(low)
        scores.append(score + end - start)
        back.append(k)
    k = max(range(len(matches)), key=lambda k: (scores[k], -k))
    out = []
    while k >= 0:
        out.append(matches[k])
        k = back[k]
    return out[::-1]


def chains(matches: list[Match], size: int, cover: float) -> tuple[list[tuple[int, int, int]], int]:
    """Spans (start, end, words covered) of one template, one after the other, and the most words any chain covers."""
    matches = sorted(matches)
    starts = [m[0] for m in matches]
    spans, most, at = [], 0, 0
    while at < len(matches):
        begin = starts[at]
        window = matches[at : bisect_left(starts, begin + 3 * size)]
        chain = best_chain(window, size)
        covered = sum(m[1] - m[0] for m in chain)
        most = max(most, covered)
        if covered >= cover * size:
            spans.append((chain[0][0], chain[-1][1], covered))
            at = bisect_left(starts, chain[-1][1])
        else:
            at = bisect_left(starts, begin + size)
    return spans, most


class Scanner:
    """The templates and phrases, prepared once in a task."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, run: int = RUN, cover: float = COVER):
        self.labels, self.run, self.cover = [label for label, _ in templates], run, cover
        texts = [template_words(t) for _, t in templates]
        named = [template_words(p) for p, _ in phrases]
        vocabulary = sorted({w for t in texts + named for w in t})
        ids = {w: k for k, w in enumerate(vocabulary)}
        raw = [w.encode() for w in vocabulary]
        self.width = -(-max(map(len, raw)) // 8) * 8
        self.spelled = np.frombuffer(b"".join(w.ljust(self.width, b"\0") for w in raw), np.uint64).reshape(len(raw), -1)
        self.odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
        hashed = self._mixed(self.spelled)
        self.order = np.argsort(hashed)
        self.hashed = hashed[self.order]
        self.base = len(raw)
        numbered = [[ids[w] for w in t] for t in texts]
        self.sizes = [len(t) for t in numbered]
        self.automaton = Automaton(numbered)
        self.runs = np.unique([self._key(t[k : k + run]) for t in numbered for k in range(len(t) - run + 1)])
        self.phrases = [[ids[w] for w in p] for p in named]

    def _mixed(self, spelled: np.ndarray) -> np.ndarray:
        out = np.zeros(len(spelled), np.uint64)
        for k in range(spelled.shape[1]):
            out = (out ^ spelled[:, k]) * self.odd[k % 4]
            out ^= out >> np.uint64(29)
        return out

    def _key(self, words: list[int]) -> int:
        key = 0
        for w in words:
            key = key * self.base + w
        return key

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each word's number in the vocabulary, compared letter by letter; -1 if it is in no template."""
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(ends - starts <= self.width)
        if not len(short):
            return out
        padded = np.concatenate([data, np.zeros(self.width, np.uint8)])
        letters = padded[starts[short, None] + np.arange(self.width)]
        letters[np.arange(self.width) >= (ends - starts)[short, None]] = 0
        spelled = letters.view(np.uint64)
        hashed = self._mixed(spelled)
        at = np.minimum(np.searchsorted(self.hashed, hashed), self.base - 1)
        found = self.order[at]
        same = (self.spelled[found] == spelled).all(axis=1)
        out[short[same]] = found[same]
        return out

    def scanned(self, column: pa.Array) -> dict[str, list]:
        """Word counts, places of the phrases and spans of every text."""
        offsets = _offsets(column)
        first, n = int(offsets[0]), len(column)
        raw = column.buffers()[2]
        data = _FOLD[np.frombuffer(raw, np.uint8)[first : int(offsets[-1])]] if raw else np.empty(0, np.uint8)
        offsets = offsets - first
        inside = _INSIDE[data]
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        begin[offsets[:-1][filled]] = inside[offsets[:-1][filled]]
        stop[offsets[1:][filled] - 1] = inside[offsets[1:][filled] - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        bounds = np.searchsorted(starts, offsets)
        words = self.numbers(data, starts, ends)
        owner = np.repeat(np.arange(n), np.diff(bounds))

        def together(size: int) -> np.ndarray:
            """Whether a run of so many words of templates begins at each word, within its text."""
            if len(words) < size:
                return np.zeros(0, bool)
            known = words >= 0
            out = owner[: len(words) - size + 1] == owner[size - 1 :]
            for k in range(size):
                out = out & known[k : len(words) - size + 1 + k]
            return out

        places: list[list[dict]] = [[] for _ in range(n)]
        for p, phrase in enumerate(self.phrases):
            hit = together(len(phrase))
            for k, word in enumerate(phrase):
                hit = hit & (words[k : k + len(hit)] == word)
            for at in np.flatnonzero(hit).tolist():
                places[owner[at]].append({"phrase": p, "at": at - int(bounds[owner[at]])})

        at = np.flatnonzero(together(self.run))
        key = np.zeros(len(at), np.int64)
        for k in range(self.run):
            key = key * self.base + words[at + k]
        near = np.minimum(np.searchsorted(self.runs, key), len(self.runs) - 1)
        at = at[self.runs[near] == key]
        spans: list[list[dict]] = [[] for _ in range(n)]
        best = [0.0] * n
        if len(at):
            # stretches of such runs, and the texts they are in
            cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner[at]) > 0)) + 1
            lows, highs = at[np.append(0, cut)], at[np.append(cut - 1, len(at) - 1)] + self.run
            by_text: dict[int, dict[int, list[Match]]] = {}
            for low, high in zip(lows.tolist(), highs.tolist()):
                d = int(owner[low])
                own = by_text.setdefault(d, {})
                base = low - int(bounds[d])
                for end, size, state in self.automaton.matches(words[low:high].tolist(), self.run):
                    for t, stop_at in self.automaton.ends[state]:
                        own.setdefault(t, []).append((base + end - size, base + end, stop_at - size, stop_at))
            for d, own in by_text.items():
                spans[d], best[d] = self._spans(own)
        return {"n_words": np.diff(bounds).tolist(), "places": places, "spans": spans, "best_share": best}

    def _spans(self, by_template: dict[int, list[Match]]) -> tuple[list[dict], float]:
        found, best = [], 0.0
        for t in sorted(by_template):
            size = self.sizes[t]
            spans, most = chains(by_template[t], size, self.cover)
            best = max(best, most / size)
            found += [
                {"label": self.labels[t], "template": t, "start": a, "end": b, "covered": c, "share": c / size} for a, b, c in spans
            ]
        # the spans of a label from left to right, the longest first: one that ends no later than another lies within it
        out, reach = [], {}
        for s in sorted(found, key=lambda s: (s["start"], -s["end"], -s["covered"], s["template"])):
            if s["end"] > reach.get(s["label"], -1):
                out.append(s)
                reach[s["label"]] = s["end"]
        return out, best


def scan(docs: DataFrame, text: str = "text", id: str = "doc_id", templates=TEMPLATES, run: int = RUN, cover: float = COVER) -> DataFrame:
    """doc_id, n_words, places of the phrases, spans of the templates and the largest share of a template, for every row."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, PHRASES, run, cover)
        for batch in batches:
            column = texts_array(batch.column(1))
            for a, b in slices(column):
                found = scanner.scanned(column.slice(a, b - a))
                kinds = {"n_words": pa.int64(), "places": _PLACES, "spans": _SPANS, "best_share": pa.float64()}
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column(0).slice(a, b - a)} | {k: pa.array(found[k], kind) for k, kind in kinds.items()})
        finished()

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tasks, SCANNED)


_PLACES = pa.list_(pa.struct([("phrase", pa.int32()), ("at", pa.int64())]))
_SPANS = pa.list_(pa.struct([
    ("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()),
    ("share", pa.float64()),
]))


def digest(rows: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(label) for _, label in PHRASES))
    at = F.col("places.at")
    named = F.array_distinct(F.transform("places", lambda p: F.get(names, p["phrase"])))
    score = F.greatest(F.col("best_share"), F.when(F.size("places") > 0, F.lit(NAMED)).otherwise(F.lit(0.0)))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"), F.array_join(F.array_sort(named), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(named, F.array_distinct(F.col("spans.label")))), ",").alias("labels"),
        score.alias("score"),
    )
