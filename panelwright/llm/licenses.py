"""License scans: a suffix automaton over the words of all templates gives, at every word of a text, the longest run of
template words that ends there; long runs are chained into spans of a template."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, text_map
from .textvec import LOWER, NOT_ALNUM, Words, buffers, chunks

#: Phrases that name a license, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Well-known sentences of public licenses, with the labels that the method adds.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "Licensed under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "GNU General Public License"),
    ("gpl", "Licensed under the GPL version 2"),
    ("gpl", "Licensed under the GPL version 3"),
    ("lgpl", "GNU Lesser General Public License"),
    ("lgpl", "GNU Library General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("gfdl", "GNU Free Documentation License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Distributed under the MIT License"),
    ("apache-2", "Licensed under the Apache License 2.0"),
    ("bsd", "under the BSD License"),
    ("bsd", "BSD 3-Clause License"),
    ("bsd", "BSD 2-Clause License"),
    ("isc", "under the ISC License"),
    ("mpl-2", "Mozilla Public License"),
    ("epl", "Eclipse Public License"),
    ("eupl", "European Union Public Licence"),
    ("cddl", "Common Development and Distribution License"),
    ("boost", "Boost Software License"),
    ("odbl", "Open Database License"),
    ("ofl", "SIL Open Font License"),
    ("artistic", "under the Artistic License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "CC0 1.0 Universal"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher"),
]
#: A run counts from so many words; runs of one chain lie at most so many words apart, in the text and in the template; a
#: label needs so many words of its template, or this share of it. A template of fewer words than LEAST_WORDS has to stand whole,
#: and one of fewer than LONG words without a gap: in short notices each word tells licenses apart.
LEAST_RUN, GAP, LEAST_WORDS, LEAST_SHARE, LONG = 3, 12, 10, 0.8, 20


def read_templates(folder: str) -> list[tuple[str, str]]:
    """(label, text) of each whole license text in a folder that a caller names, on the driver; none where there is no such
    folder. A file's name is its label (Apache-2.0: apache-2); links are other names of the same texts."""
    files = sorted(f for f in Path(folder).glob("*") if f.is_file() and not f.is_symlink())
    return [(f.name.lower().removesuffix(".0"), f.read_text(encoding="utf-8", errors="replace")) for f in files]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    words = Words(LOWER[data], offsets, NOT_ALNUM)
    return words, words.hashes()


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]))[1]


class SuffixAutomaton:
    """All runs of words in several sequences. Each state holds runs that end at the same places; `ends` gives, by
    sequence, the first such place."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        self.whole: dict[int, list[tuple[int, int]]] = {}  # by state: sequences that end there with their first word in it
        for k, words in enumerate(sequences):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].setdefault(k, i + 1)
            self.whole.setdefault(last, []).append((k, len(words)))
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                up = self.ends[self.link[s]]
                for k, i in self.ends[s].items():
                    up[k] = min(i, up.get(k, i))

        # the nearest state on the way to shorter runs where a whole sequence ends
        self.above = [0] * len(self.length)
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[s]
            self.above[s] = up if up in self.whole else self.above[up] if up > 0 else 0

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.ends.append({})
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._state(self.length[last] + 1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def runs(self, words) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of every run of `words` that can't be made longer to the right."""
        s, n = 0, 0
        for i, w in enumerate(words):
            before = (i, n, s)
            while s and w not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if w in self.next[s]:
                s, n = self.next[s][w], n + 1
            else:
                n = 0
            if n <= before[1] and before[1]:
                yield before
        if n:
            yield len(words), n, s

    def wholes(self, words) -> Iterator[tuple[int, int, int]]:
        """(end, length, sequence) of every place where a whole sequence stands, inside longer runs too."""
        s, n = 0, 0
        for i, w in enumerate(words):
            while s and w not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            s, n = (self.next[s][w], n + 1) if w in self.next[s] else (0, 0)
            at = s if s in self.whole else self.above[s]
            while at:
                for k, size in self.whole[at]:
                    if size <= n:
                        yield i + 1, size, k
                at = self.above[at]


class Scanner:
    """Finds phrases and template spans in many texts at once."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES):
        self.phrases = [(label, _hashes(p)) for p, label in phrases.items()]
        sequences = [_hashes(t) for _, t in templates]
        self.alphabet = np.unique(np.concatenate([*sequences, *(p for _, p in self.phrases), np.zeros(0, np.uint64)]))
        self.labels, self.sizes = [label for label, _ in templates], [len(s) for s in sequences]
        self.gaps = [GAP if n >= LONG else 0 for n in self.sizes]
        self.automaton = SuffixAutomaton([np.searchsorted(self.alphabet, s).tolist() for s in sequences])
        self.phrases = [(label, np.searchsorted(self.alphabet, p)) for label, p in self.phrases]
        # the shortest runs that count: only where one of them stands is the automaton asked
        self.shortest = np.unique(np.concatenate([self._short_runs(np.searchsorted(self.alphabet, s)) for s in sequences] or [np.zeros(0, np.int64)]))

    def _short_runs(self, ids: np.ndarray) -> np.ndarray:
        """A number for each run of LEAST_RUN words; -1 where one of them is in no template."""
        n = max(0, len(ids) - LEAST_RUN + 1)
        out, there = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(LEAST_RUN):
            out = out * (len(self.alphabet) + 1) + ids[k : n + k]
            there &= ids[k : n + k] >= 0
        return np.where(there, out, -1)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == hashes, at, -1)

    def chains(self, ids: np.ndarray, shift: int) -> list[tuple[str, int, int, float]]:
        """(label, first word, last word, share of the template covered) of the chains in a run of template words."""
        found: dict[int, list[list[int]]] = {}
        for end, n, state in self.automaton.runs(ids.tolist()):
            if n < LEAST_RUN:
                continue
            for k, at in self.automaton.ends[state].items():
                if self.sizes[k] < LEAST_WORDS:
                    continue
                chains = found.setdefault(k, [])
                best = None
                for c in reversed(chains):
                    if end - n - c[1] > self.gaps[k]:
                        break
                    over = max(0, c[1] - (end - n), c[2] - (at - n))
                    if over < n and c[2] <= at and at - n - c[2] <= self.gaps[k] and (best is None or c[3] - over > best[3] - best[4]):
                        best = [*c[:4], over, c]
                if best:
                    best[5][4] = True  # it goes on, so it is no whole chain
                chains.append([best[0] if best else end - n, end, at, n + (best[3] - best[4] if best else 0), False])
        # short notices stand whole
        out = [(self.labels[k], shift + end - n, shift + end - 1, 1.0) for end, n, k in self.automaton.wholes(ids.tolist()) if n < LEAST_WORDS]
        for k, chains in found.items():
            for first, end, _, covered, goes_on in chains:
                if not goes_on and covered >= min(LEAST_WORDS, LEAST_SHARE * self.sizes[k]):
                    out.append((self.labels[k], shift + first, shift + end - 1, min(1.0, covered / self.sizes[k])))
        return self._widest(out)

    def _widest(self, spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
        """Spans that no other one of their label holds; of equal ones the one that covers most of its template."""
        out: list[tuple[str, int, int, float]] = []
        last: dict[str, int] = {}
        for s in sorted(spans, key=lambda s: (s[1], -s[2], -s[3])):
            if s[2] > last.get(s[0], -1):
                out.append(s)
                last[s[0]] = s[2]
        return out

    def scan(self, texts: pa.Array) -> list[tuple]:
        """For each text: n_words, n_base, first_word, last_word, base labels, spans (label, first, last, share)."""
        data, offsets = buffers(texts)
        out: list[tuple] = []
        for a, b in chunks(offsets):
            words, hashes = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            ids = self.ids(hashes)
            hits: dict[int, list[tuple[int, str]]] = {}
            for label, phrase in self.phrases:
                n = len(phrase)
                if len(ids) < n:
                    continue
                ok = words.doc[: len(ids) - n + 1] == words.doc[n - 1 :]
                for k in range(n):
                    ok &= ids[k : len(ids) - n + 1 + k] == phrase[k]
                for i in np.flatnonzero(ok).tolist():
                    hits.setdefault(int(words.doc[i]), []).append((i - int(words.first[words.doc[i]]), label))
            # stretches of short template runs that lie near each other, in one text
            spans: dict[int, list] = {}
            short = self._short_runs(ids)
            at = np.minimum(np.searchsorted(self.shortest, short), max(0, len(self.shortest) - 1))
            hit = np.flatnonzero((self.shortest[at] == short) & (words.doc[: len(short)] == words.doc[len(words.doc) - len(short) :])) if len(self.shortest) else np.zeros(0, np.int64)
            if len(hit):
                cut = np.flatnonzero((np.diff(hit) > GAP + LEAST_RUN) | (np.diff(words.doc[hit]) != 0)) + 1
                for i, j in zip(hit[np.r_[0, cut]].tolist(), (hit[np.r_[cut - 1, len(hit) - 1]] + LEAST_RUN).tolist(), strict=True):
                    d = int(words.doc[i])
                    got = self.chains(ids[i:j], i - int(words.first[d]))
                    if got:
                        spans.setdefault(d, []).extend(got)
            for d in range(b - a):
                at = hits.get(d, [])
                out.append((int(words.n[d]), len(at), min(at)[0] if at else None, max(at)[0] if at else None, sorted({x for _, x in at}), spans.get(d, [])))
        return out


SPAN = "array<struct<label:string,first_word:long,last_word:long,share:double>>"


@lru_cache(maxsize=1)
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    """Built once in a worker."""
    return Scanner(templates=list(templates))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels, score and spans (the chains found).

    templates: (label, text), a list that people keep; by default the sentences and short notices of TEMPLATES, the same on
    every machine (read_templates() takes whole texts from a folder).
    Words run from 0. Null texts count as empty: no words, no labels (empty strings), score 0. Score is 1 where a phrase
    stands, else the largest share of a template that one chain covers. Columns with these names are replaced, all
    others stay; repeated rows are scanned one by one.
    """
    kinds = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())]))

    shared = docs.sparkSession.sparkContext.broadcast(tuple(templates if templates is not None else TEMPLATES))

    def start():
        scanner = _scanner(shared.value)

        def work(texts: pa.Array) -> list[pa.Array]:
            rows = scanner.scan(texts)
            return [
                *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4)),
                pa.array([",".join(r[4]) for r in rows], pa.string()),
                pa.array([",".join(sorted({*r[4], *(x[0] for x in r[5])})) for r in rows], pa.string()),
                pa.array([1.0 if r[1] else max((x[3] for x in r[5]), default=0.0) for r in rows], pa.float64()),
                pa.array([[dict(zip(("label", "first_word", "last_word", "share"), x, strict=True)) for x in r[5]] for r in rows], kinds),
            ]

        return work

    return text_map(docs, f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {SPAN}", start)


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "spans")
