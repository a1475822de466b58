"""License scans.

Templates are license notices and whole license texts. Their word shingles are winnowed: of every run of `window` shingles
one is kept, so any shingle + window - 1 words that a document has of a template hold a kept one. The kept fingerprints
form an inverted index; a template is a candidate in a document that has one of its fingerprints. A template too short
for that is indexed by its words, and is a candidate where enough of them occur. What a document costs depends on the
templates that it shares fingerprints or words with, not on how many there are.

In a candidate, the document's words vote for the shifts between template and document; for each shift with enough
template words within the band to reach the coverage, a banded alignment gives the matched coverage and span. That part
misses nothing of a candidate; what has the coverage but no fingerprint (a word changed or inserted in every few) is no
candidate and not reported.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect, insort
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import append_columns

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: Common license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
}


#: The bodies of whole license texts, without titles and copyright lines.
FULL_TEXTS = {
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
        "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
}


@dataclass(frozen=True)
class LicenseConfig:
    """band: words that alignment may shift; least_coverage: share of a template's words that must be matched; shingle,
    window: of the fingerprints; short: templates of fewer words are indexed by words."""

    band: int = 8
    least_coverage: float = 0.8
    shingle: int = 3
    window: int = 4
    short: int = 16


def words(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and other characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_NORMAL).split()


def winnow(hashes: list[int], window: int) -> list[int]:
    """Positions kept: in every run of `window` hashes the rightmost least one; fewer hashes: the least of all."""
    kept: list[int] = []
    for start in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = hashes[start : start + window]
        at = start + max(k for k, h in enumerate(part) if h == min(part))
        if not kept or kept[-1] != at:
            kept.append(at)
    return kept


def align(template: list, found: list, shift: int, band: int) -> tuple[int, int, int]:
    """Longest common subsequence of two word lists where found[j] meets template[i] only if |j - i - shift| <= band.

    Returns the number of matched words and the first and last (exclusive) matched positions in found; among equal
    numbers the shortest span, then the first.
    """
    best = (0, 0, 0)
    above: dict[int, tuple[int, int, int]] = {}  # position in found -> (matches, -span start, -end), by template row
    for i, word in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        low, high = max(0, i + shift - band), min(len(found) - 1, i + shift + band)
        left = above.get(low - 1, (0, 0, 0))
        for j in range(low, high + 1):
            here = max(left, above.get(j, (0, 0, 0)))
            if found[j] == word:
                n, start, _ = above.get(j - 1, (0, 0, 0))
                here = max(here, (n + 1, start if n else j, -(j + 1)))
            row[j] = left = here
        above = row
        if row:
            best = max(best, max(row.values()))
    n, start, end = best
    return n, start, -end


class LicenseIndex:
    """Inverted index: fingerprints to long templates, words to short ones."""

    def __init__(self, templates: dict[str, str], config: LicenseConfig):
        self.config = config
        self.templates = {name: found for name, text in templates.items() if (found := words(text))}
        self.numbers: dict[bytes, int] = {}
        self.short: dict[bytes, list[str]] = defaultdict(list)
        holders: dict[int, set[str]] = defaultdict(set)
        for name, found in self.templates.items():
            codes = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in found], dtype=np.uint64)
            if len(found) < max(config.short, config.shingle):
                for w in found:
                    self.short[w].append(name)
                continue
            hashes = self._shingles(codes)
            for k in winnow(hashes.tolist(), config.window):
                holders[int(hashes[k])].add(name)
        self.holders = holders
        self.fingerprints = np.sort(np.array(list(holders), dtype=np.uint64))

    def _shingles(self, codes: np.ndarray) -> np.ndarray:
        """A hash of the shingle that begins at each place."""
        n = len(codes) - self.config.shingle + 1
        h = np.zeros(max(0, n), dtype=np.uint64)
        for k in range(self.config.shingle if n > 0 else 0):
            h = (h ^ codes[k : n + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def candidates(self, found: list[bytes]) -> list[str]:
        """The templates that the words may hold, by name."""
        look = self.numbers.get
        codes = np.array([look(w, 0) for w in found], dtype=np.uint64)
        known = np.flatnonzero(codes)
        if not len(known):
            return []
        names: set[str] = set()
        if len(self.fingerprints):
            h = self._shingles(codes)
            at = np.minimum(np.searchsorted(self.fingerprints, h), len(self.fingerprints) - 1)
            for hit in np.unique(h[self.fingerprints[at] == h]).tolist():
                names |= self.holders[hit]
        counts = Counter(name for w in {found[k] for k in known} for name in self.short.get(w, ()))
        names |= {name for name, n in counts.items() if self._enough(n, self.templates[name])}
        return sorted(names)

    def find(self, text: str) -> list[dict]:
        """Matches as template, coverage, start, stop (code points), words matched, in order of start and template.

        Matches of one template don't overlap: the one of most words comes first (of equals the later start, then the
        earlier end), then the best one in the words that are left, until no shift has a match in these.
        """
        found = words(text)
        likely = self.candidates(found)
        if not likely:
            return []
        wanted = {w for name in likely for w in self.templates[name]}
        at: dict[bytes, list[int]] = defaultdict(list)
        for j, w in enumerate(found):
            if w in wanted:
                at[w].append(j)
        out, spans = [], None
        for name in likely:
            template = self.templates[name]
            for n, first, last in self._select(template, found, self._shifts(template, at, len(found))):
                spans = spans or [m.span() for m in _WORD.finditer(text)]
                start, stop = spans[first][0], spans[last - 1][1]
                out.append({"template": name, "coverage": n / len(template), "start": start, "stop": stop, "matched": n})
        return sorted(out, key=lambda m: (m["start"], m["template"]))

    def _enough(self, n, template: list[bytes]):
        return n / len(template) >= self.config.least_coverage

    def _shifts(self, template: list[bytes], at: dict[bytes, list[int]], n_found: int) -> list[int]:
        """All shifts for which enough template words occur within the band; no other can have a match."""
        band = self.config.band
        zero = len(template) - 1 + band
        votes = np.zeros(n_found + zero + band, dtype=np.int32)
        for i, w in enumerate(template):
            if w in at:
                low = np.array(at[w]) - i + zero - band
                edges = np.zeros(len(votes) + 1, dtype=np.int32)
                edges[low] += 1
                edges[low + 2 * band + 1] -= 1
                votes += np.cumsum(edges[:-1]) > 0
        return (np.flatnonzero(self._enough(votes, template)) - zero).tolist()

    def _select(self, template: list[bytes], found: list[bytes], shifts: list[int]) -> list[tuple[int, int, int]]:
        """(matched words, first, last) of matches that don't overlap, best first.

        A shift is aligned anew only when its match comes up but meets one already selected: matches only get worse as
        fewer words are left, so the best of the heap is the best of all.
        """
        band, taken, heap = self.config.band, [], []

        def push(shift: int) -> None:
            low, high = max(0, shift - band), min(len(found), shift + len(template) + band)
            k = max(0, bisect(taken, (low, -1)) - 1)
            best = (0, 0, 0)
            while low < high:
                while k < len(taken) and taken[k][1] <= low:
                    k += 1
                stop = min(high, max(low, taken[k][0])) if k < len(taken) else high
                if stop > low:
                    n, first, last = align(template, found[low:stop], shift - low, band)
                    best = max(best, (n, low + first, -(low + last)))
                low = max(stop, taken[k][1]) if k < len(taken) else high
            n, first, last = best
            if n and self._enough(n, template):
                heapq.heappush(heap, (-n, -first, -last, shift))

        for shift in shifts:
            push(shift)
        out = []
        while heap:
            n, first, last, shift = heapq.heappop(heap)
            n, first = -n, -first
            k = bisect(taken, (first, last))
            free = (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or taken[k][0] >= last)
            if free:
                insort(taken, (first, last))
                out.append((n, first, last))
            push(shift)
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, config: LicenseConfig = LicenseConfig(), text_col="text") -> DataFrame:
    """docs with licenses: array of (template, coverage, start, stop, matched), in order of start.

    Whole texts; null and empty texts and texts without a match have an empty array; a template without words never
    matches; a column of that name is replaced; repeated rows stay; no shuffle. The templates are a parameter, so the
    index that tasks hold does not grow with the corpus.
    """
    known = TEMPLATES | FULL_TEXTS if templates is None else dict(templates)
    fields = [("template", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("stop", pa.int64()), ("matched", pa.int64())]

    def make():
        index = LicenseIndex(known, config)
        return lambda texts: [pa.array([index.find(t) for t in texts], pa.list_(pa.struct(fields)))]

    kind = "array<struct<template:string,coverage:double,start:bigint,stop:bigint,matched:bigint>>"
    return append_columns(docs, text_col, make, f"licenses {kind}")


def matches(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per match: doc_id, template, coverage, start, stop, matched."""
    found = scan(docs, **options).select(F.col(f"`{id_col}`").alias("doc_id"), F.explode("licenses").alias("m"))
    return found.select("doc_id", "m.*")
