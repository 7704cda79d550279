"""License scans by patience alignment (operator 2).

A document and a license template are compared as sequences of words. Words that
occur once in both are anchors; the longest increasing subsequence of their
places is kept, and the gaps between anchors are aligned the same way. Coverage
is the part of the template's words that are aligned. As a template may stand
anywhere in a long text, and more than once, the places of the template's longer
words vote for where a copy begins, and each cluster of votes is aligned alone.

Defined results: a license is found if ``COVERAGE`` of its words are aligned in
one place; of templates found there the one with most aligned words counts, then the
shorter one, then the first in alphabetical order; null and empty texts have none;
repeated rows give repeated results; texts of any length are read whole; an empty
table gives no rows; only doc_id and text are read. No text is left out: a copy needs at least one of the template's longer words, and texts without
any such word are passed over.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .common import map_batches

COVERAGE = 0.8
#: Shortest word that votes.
SEED_LENGTH = 5
_WORD = re.compile(r"[a-z0-9]+")

# Notices and short texts of public licenses.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-mention": "the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-mention": "Apache License, Version 2.0",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"
    ),
    **{
        name: (
            f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} "
            f"License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
            "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"
        )
        for name, kind, version in (
            ("GPL-2.0", "General Public", "2"), ("LGPL-2.1", "Lesser General Public", "2.1"), ("LGPL-3.0", "Lesser General Public", "3"),
            ("AGPL-3.0", "Affero General Public", "3"),
        )
    },
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "as-is-MIT": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE."
    ),
}


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, sorted by the first, whose second ascends (patience piles)."""
    tops: list[int] = []
    held: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        lo, hi = 0, len(tops)
        while lo < hi:
            mid = (lo + hi) // 2
            if tops[mid] < b:
                lo = mid + 1
            else:
                hi = mid
        back.append(held[lo - 1] if lo else -1)
        if lo == len(tops):
            tops.append(b)
            held.append(i)
        else:
            tops[lo], held[lo] = b, i
    out, i = [], held[-1] if held else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        places = [defaultdict(list), defaultdict(list)]
        for where, seq, lo, hi in ((places[0], a, a0, a1), (places[1], b, b0, b1)):
            for i in range(lo, hi):
                where[seq[i]].append(i)
        once = sorted((p[0], places[1][w][0]) for w, p in places[0].items() if len(p) == 1 and len(places[1].get(w, ())) == 1)
        at_a, at_b = a0, b0
        anchors = _increasing(once)
        for x, y in anchors:
            out.append((x, y))
            todo.append((at_a, x, at_b, y))
            at_a, at_b = x + 1, y + 1
        if anchors:
            todo.append((at_a, a1, at_b, b1))
    return sorted(out)


@dataclass(frozen=True)
class Found:
    license: str
    coverage: float
    matched: int
    start: int
    end: int


class LicenseScanner:
    def __init__(self, templates: dict[str, str] | None = None, coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = {k: words(t) for k, t in (templates or TEMPLATES).items()}
        #: word -> (template, place) of each longer word
        self.seeds: dict[str, list[tuple[str, int]]] = defaultdict(list)
        self.n_seeds: dict[str, int] = {}
        for name, seq in self.templates.items():
            long = [i for i, w in enumerate(seq) if len(w) >= SEED_LENGTH]
            # with this many, coverage can't be reached without one of them
            if len(long) <= len(seq) * (1 - coverage):
                long = list(range(len(seq)))
            self.n_seeds[name] = len(long)
            for i in long:
                self.seeds[seq[i]].append((name, i))

    def scan(self, text: str | None) -> list[Found]:
        """Licenses in order of place; ``start`` and ``end`` count words."""
        seq = words(text)
        if self.seeds.keys().isdisjoint(seq):
            return []
        votes: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for p, w in enumerate(seq):
            for name, i in self.seeds.get(w, ()):
                votes[name].append((p - i, i))
        found = []
        for name, given in votes.items():
            slack = 3 + len(self.templates[name]) // 4
            given.sort()
            start = 0
            for end in range(1, len(given) + 1):
                if end < len(given) and given[end][0] - given[end - 1][0] <= slack:
                    continue
                found += self._cluster(seq, name, given[start:end], slack)
                start = end
        found.sort(key=lambda f: (-f.matched, -f.coverage, f.start, f.license))
        kept: list[Found] = []
        for f in found:
            if all(f.end <= k.start or f.start >= k.end for k in kept):
                kept.append(f)
        return sorted(kept, key=lambda f: f.start)


    def _aligned(self, seq: list[str], name: str, lo: int, hi: int) -> Found | None:
        """The template in words ``lo`` to ``hi``, if it is covered."""
        template, lo = self.templates[name], max(0, lo)
        pairs = align(seq[lo:hi], template)
        if not pairs or len(pairs) < self.coverage * len(template):
            return None
        return Found(name, len(pairs) / len(template), len(pairs), lo + pairs[0][0], lo + pairs[-1][0] + 1)

    def _cluster(self, seq: list[str], name: str, votes: list[tuple[int, int]], slack: int) -> list[Found]:
        """Copies of a template in a cluster of its sorted votes (offset, place in the template)."""
        size = len(self.templates[name])
        out: list[Found] = []
        for o in self._peaks(name, votes, slack):
            # copies found before are a border; a peak that lies mostly in one is part of it
            if any(min(f.end, o + size) - max(f.start, o) > size // 2 for f in out):
                continue
            below = max((f.end for f in out if f.start <= o), default=0)
            above = min((f.start for f in out if f.start > o), default=len(seq))
            tried = [self._aligned(seq, name, max(below, o - d), min(above, o + size + d)) for d in dict.fromkeys((slack, slack // 2, slack // 4, 1, 0))]
            best = max((f for f in tried if f), key=lambda f: (f.matched, f.start - f.end), default=None)
            if best:
                out.append(best)
        if len(out) < 2:
            whole = self._aligned(seq, name, votes[0][0] - slack, votes[-1][0] + size + slack)
            if whole and (not out or whole.matched > out[0].matched):
                return [whole]
        return out

    def _peaks(self, name: str, votes: list[tuple[int, int]], slack: int) -> list[int]:
        """Offsets, those of most votes first, with votes for enough places within ``slack`` for a copy."""
        size = len(self.templates[name])
        least = max(1, self.n_seeds[name] - int(size * (1 - self.coverage) + 1e-9))
        exact = Counter(o for o, _ in votes)
        near: Counter[int] = Counter()
        a = b = 0
        out = []
        for o in exact:
            while b < len(votes) and votes[b][0] <= o + slack:
                near[votes[b][1]] += 1
                b += 1
            while votes[a][0] < o - slack:
                near[votes[a][1]] -= 1
                if not near[votes[a][1]]:
                    del near[votes[a][1]]
                a += 1
            if len(near) >= least:
                out.append(o)
        return sorted(out, key=lambda o: (-exact[o], o))


def license_report(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row a document: its best license (or null) and all found, in order of place."""
    scanner = LicenseScanner(templates, coverage)

    def step(rows: dict[str, list]) -> dict[str, list]:
        every = [scanner.scan(t) for t in rows["text"]]
        best = [max(f, key=lambda x: (x.matched, -x.start), default=None) for f in every]
        return {
            "doc_id": rows["doc_id"],
            "license": [b and b.license for b in best],
            "coverage": [b.coverage if b else 0.0 for b in best],
            "n_matched": [b.matched if b else 0 for b in best],
            "n_licenses": [len(f) for f in every],
            "licenses": [",".join(f"{x.license}:{x.start}:{x.end}" for x in f) for f in every],
        }

    schema = "doc_id bigint, license string, coverage double, n_matched bigint, n_licenses bigint, licenses string"
    return map_batches(docs, ["doc_id", "text"], schema, step)
