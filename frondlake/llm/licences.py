"""Licence scan: a generalised suffix automaton of licence tokens streams over whole texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frondlake.llm.common import column

#: fixed values: phrases whose every place counts, and their labels
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: fixed values: public licence texts, their opening passages and the notices that name them
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "agpl-notice": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "mit-notice": "Released under the MIT License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc-by-text": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mit-whole": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-2-clause-whole": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc-whole": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
}
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII bytes."""
    return text.translate(_LETTERS).split()


class Automaton:
    """Suffix automaton of several token sequences: a state stands for the factors that end at the
    same places, and knows those places."""

    def __init__(self, sequences: list[list[bytes]]):
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for s in sequences for w in s))}
        self.next, self.link, self.size, self.ends = [{}], [-1], [0], [[]]
        for t, seq in enumerate(sequences):
            last = 0
            for at, word in enumerate(seq):
                last = self._extend(last, self.vocabulary[word])
                self.ends[last].append((t, at))
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.link[v]
            if up > 0:
                self.ends[up] = sorted(set(self.ends[up]) | set(self.ends[v]))

    def _state(self, nxt: dict, link: int, size: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.size.append(size)
        self.ends.append([])
        return len(self.size) - 1

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.size[q] == self.size[last] + 1 else self._clone(last, q, c)
        cur = self._state({}, 0, self.size[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.size[q] == self.size[p] + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        copy = self._state(dict(self.next[q]), self.link[q], self.size[p] + 1)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def statistics(self, words: list[bytes]):
        """(position, state, length of the longest factor ending there), where that is not 0."""
        nxt, link, size = self.next, self.link, self.size
        v = n = 0
        for i, c in enumerate(map(self.vocabulary.get, words)):
            if c is None:
                v = n = 0
                continue
            while c not in nxt[v] and v:
                v = link[v]
                n = size[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
                yield i, v, n


class Scanner:
    """Phrases and templates in one automaton. ``shortest``: words of a match that may join a chain;
    ``gap``: words between two matches of a chain; ``cover``: share of a template that makes a span.
    A template of up to ``whole`` words must be there whole, and every template's words with digits
    (its version) must be among the covered ones."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str], shortest: int = 3, gap: int = 16, cover: float = 0.6, whole: int = 16):
        self.labels = [*phrases.values(), *templates]
        self.sequences = [tokens(t.encode()) for t in (*phrases, *templates.values())]
        self.n_phrases, self.shortest, self.gap, self.cover, self.whole = len(phrases), shortest, gap, cover, whole
        self.automaton = a = Automaton(self.sequences)
        # words with digits, as a bit per place
        self.versions = [sum(1 << i for i, w in enumerate(s) if any(48 <= c <= 57 for c in w)) for s in self.sequences]
        # a phrase ends wherever its state or one that has it as a suffix is met
        own: dict[int, list] = {}
        for t, seq in enumerate(self.sequences[:self.n_phrases]):
            v = 0
            for word in seq:
                v = a.next[v][a.vocabulary[word]]
            own.setdefault(v, []).append((t, len(seq)))
        self.phrase_at: list[list] = [[] for _ in a.size]
        # the places of a state's last ``shortest`` words: those of the suffix state that stands for them
        self.places: list[list] = [[] for _ in a.size]
        for v in sorted(range(1, len(a.size)), key=a.size.__getitem__):
            self.phrase_at[v] = own.get(v, []) + self.phrase_at[a.link[v]]
            if a.size[v] >= shortest:
                up = a.link[v]
                self.places[v] = self.places[up] if a.size[up] >= shortest else [(t, e) for t, e in a.ends[v] if t >= self.n_phrases]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int, int]]]:
        """(words, places of phrases as (phrase, start), spans as (template, start, end, covered, versions))."""
        words = tokens(text)
        places, matches = [], []
        # per place of a template that a match has reached: the length of that match
        held, at = {}, -1
        for i, v, n in self.automaton.statistics(words):
            for t, size in self.phrase_at[v]:
                if n >= size:
                    places.append((t, i - size + 1))
            if n < self.shortest and not held:
                continue
            now = {}
            if n >= self.shortest:
                near = held if at == i - 1 else {}
                now = {(t, e): near.get((t, e - 1), self.shortest - 1) + 1 for t, e in self.places[v]}
            matches.extend((at, t, e, m) for (t, e), m in held.items() if at != i - 1 or (t, e + 1) not in now)
            held, at = now, i
        matches.extend((at, t, e, m) for (t, e), m in held.items())
        return len(words), places, self._chains(matches) if matches else []

    def _chains(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
        """Chains of matches that run through one template in order, the best of overlapping ones.
        A chain is open while a match can still follow within the gap, so few are at any time."""
        open_: dict[int, list[tuple[int, int, int, int, int]]] = {}
        best: dict[int, list[list[int]]] = {}
        for end, t, e, n in matches:
            start, covered = end - n + 1, n
            seen = ((1 << n) - 1 << e - n + 1) & self.versions[t]
            here = seen
            near = [c for c in open_.get(t, ()) if end - n + 1 - c[1] <= self.gap]
            for s, last, at, got, had in near:  # (start, end, template end, covered, versions)
                add = n - max(0, last + 1 - (end - n + 1), at + 1 - (e - n + 1))
                if end > last and e > at and add > 0 and got + add > covered:
                    start, covered, seen = s, got + add, had | here
            near.append((start, end, e, covered, seen))
            open_[t] = near
            spans = best.setdefault(t, [])
            if spans and spans[-1][1] >= start:
                if (covered, seen) > tuple(spans[-1][2:]):
                    spans[-1] = [start, end, covered, seen]
            else:
                spans.append([start, end, covered, seen])
        return [(t, *s) for t, spans in best.items() for s in spans]

    def row(self, text: bytes):
        n, places, spans = self.scan(text)
        starts = [p for _, p in places]
        base = {self.labels[t] for t, _ in places}
        found, most = [], 0.0
        for t, s, e, c, seen in spans:
            size = len(self.sequences[t])
            share = min(1.0, c / size)
            whole = c >= size if size <= self.whole else share >= self.cover
            if whole and seen == self.versions[t]:
                found.append((self.labels[t], s, e + 1, round(share, 6)))
                most = max(most, share)
            else:
                most = max(most, share / 2)
        every = base | {f[0] for f in found}
        return (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(every)),
                1.0 if base else most, [dict(zip(("label", "first_word", "end_word", "cover"), f)) for f in sorted(found)])


_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("cover", pa.float64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                  ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])


def licence_spans(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
                  id_col: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row per document: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans). Every place of a phrase counts; ``spans`` are the stretches of the text that follow
    a template over at least ``cover`` of its words, holes of up to ``gap`` words allowed, its version
    numbers included; short templates only whole. A template inside a longer match of another one
    counts too. Score is 1 with a phrase, else the largest share of a template that makes a span, else
    half the largest share that a chain follows.

    One pass without a shuffle; the automaton is a few hundred states. Null and empty texts give no
    words, null positions and empty labels; repeated rows give repeated rows; a null id stays null; an
    empty table gives none. A text of any length is one pass with the open chains as memory. Columns of
    other names are ignored, whatever they are called."""
    scanner = Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates, **limits)

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.large_binary()).to_pylist()
            rows = [scanner.row(t or b"") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(_OUT)[1:]))], schema=_OUT)

    ddl = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
           "spans array<struct<label string, first_word long, end_word long, cover double>>")
    return docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text).alias("text")).mapInArrow(run, ddl)


def licence_digest(docs: DataFrame) -> DataFrame:
    return licence_spans(docs).withColumn("n_spans", F.size("spans").cast("long")).drop("spans")
