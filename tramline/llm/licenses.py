"""Operator 10, licence scans: word-bigram Dice coefficient of text windows with licence templates.

Texts and templates are normalised to words of lower-case letters and digits (bytes beyond ASCII count as letters). A
window is a run of a text's bigrams; its likeness to a template is 2 * common / (window + template), bigrams counted
with their repeats. A window that reaches LIKE is a candidate: of a template of less than SHORT bigrams the likest from
each start; of a longer one the likest, and again the likest beside the windows that stay; of equally like ones the
first, of those the shortest.

Sibling licences differ by a word or a number, which Dice hardly sees. So a candidate of a short template must name the
same variants (Lesser, Affero, NonCommercial and so on) and the template's versions, one of a long CC text the same
variants. Of candidates that overlap only the one stays that has most bigrams in common, less those of the window and
of the template that aren't. A document's licences are those of what stays.

Size bounds prune: a window that reaches LIKE has at most template * (2 - LIKE) / LIKE bigrams and holds at least
template * LIKE / (2 - LIKE) of the template's. A template with fewer of its bigrams in the whole text, or not so many
within so short a run, is never compared; and windows need only begin and end with a bigram of the template.

Defined results: null, empty and wordless texts match nothing; rows with a null doc_id are scanned; repeated rows each
stay; a text of any length is scanned whole; ties between templates go to the longer template, then by name; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common
from tramline.llm.license_texts import TEXTS

LIKE, SHORT = 0.85, 300
RESULT = "doc_id long, license string, dice double, n_licenses long, licenses string"
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
#: Words that tell sibling licences apart, and version numbers, in lower-case text.
VARIANT = re.compile(rb"\bgnu\W+(library)\b|\b(lesser|affero|non\W?commercial|nc|share\W?alike|sa|no\W?deriv(?:ative)?s|nd)\b")
ALIKE = {b"noncommercial": b"nc", b"sharealike": b"sa", b"noderivatives": b"nd", b"noderivs": b"nd"}
VERSION = re.compile(rb"(?:\b(?:version|v|by|sa|nc|nd|[al]?gpl|mpl)|cc0|attribution|commercial|alike|derivatives)[^a-z0-9\x80-\xff]*(\d+(?:\.\d+)*)")

#: Public licence texts and notices, by SPDX-like name; a name before "#" may have several.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT#notice": "Released under the MIT License.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Apache-2.0#notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-2.0#notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0#notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0#notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0#notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "CC0-1.0#notice": "Licensed under CC0 1.0 Universal.",
    "CC-BY-4.0#notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0#notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0#notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0#notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0#notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
} | TEXTS


def signature(text: bytes) -> tuple[set[bytes], set[tuple[bytes, ...]]]:
    """The variants and the versions (without trailing zeros) that a lower-case text names."""
    variants = {re.sub(rb"\W", b"", a or b) for a, b in VARIANT.findall(text)}
    versions = (x.split(b".") for x in VERSION.findall(text))
    return {ALIKE.get(x, x) for x in variants}, {tuple(x[: max((k + 1 for k, y in enumerate(x) if y.strip(b"0")), default=1)]) for x in versions}


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, like: float = LIKE):
        self.like = like
        words = {k: WORD.findall(t.encode().lower()) for k, t in templates.items()}
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for t in words.values() for w in t}))}
        self.base = len(self.ids) + 1
        self.names = sorted(templates)
        self.counts = [Counter(a * self.base + b for a, b in zip(x, x[1:], strict=False)) for x in ([self.ids[w] for w in words[k]] for k in self.names)]
        self.sizes = [sum(c.values()) for c in self.counts]
        self.signatures = [signature(templates[k].lower().encode()) for k in self.names]
        self.least = [int(np.ceil(n * like / (2 - like) - 1e-9)) for n in self.sizes]
        self.most = [int(n * (2 - like) / like + 1e-9) for n in self.sizes]
        self.holders: dict[int, list[tuple[int, int]]] = {}
        for k, c in enumerate(self.counts):
            for code, n in c.items():
                self.holders.setdefault(code, []).append((k, n))
        self.codes = np.array(sorted(self.holders), np.int64)

    def windows(self, k: int, at: np.ndarray, codes: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Likeness, start and end (in bigrams of the text) of template k's windows, from its bigrams' places: the likest
        from each start in turn, of a long template only if likelier than those before."""
        least, most, size = self.least[k], self.most[k], self.sizes[k]
        if len(at) < least:
            return
        starts = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] < most)
        reach = np.minimum(np.searchsorted(at, at[starts] + most) - starts, size)
        top = 0.0
        # a place adds to what is in common if, of its bigram, the window holds fewer before it than the template has
        order = np.argsort(codes, kind="stable")
        sorted_ = codes[order]
        earlier = np.arange(len(codes)) - np.fromiter((self.counts[k][c] for c in sorted_.tolist()), np.int64, len(codes))
        held = earlier >= np.searchsorted(sorted_, sorted_)
        full = np.full(len(codes), -1)
        full[order[held]] = order[earlier[held]]
        for i, room in zip(starts.tolist(), reach.tolist(), strict=True):
            if 2 * room / (room + size) <= top:
                continue
            end = min(len(at), i + most)
            length = at[i:end] - at[i] + 1
            likes = np.where(length <= most, 2 * np.cumsum(full[i:end] < i) / (length + size), 0.0)
            j = int(likes.argmax())
            if likes[j] >= self.like and likes[j] > top:
                yield float(likes[j]), int(at[i]), int(at[i + j]) + 1
                if size >= SHORT:
                    top = float(likes[j])

    def candidates(self, text: bytes) -> dict[int, tuple[list[tuple[float, int, int]], np.ndarray, np.ndarray]]:
        """The windows of each template that has some, and its bigrams' places and codes."""
        get = self.ids.get
        ids = np.array([get(w, 0) for w in WORD.findall(text.lower())], np.int64)
        if len(ids) < 2:
            return {}
        both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        codes = ids[both] * self.base + ids[both + 1]
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[place] == codes
        both, codes = both[known], codes[known]
        if not len(both):
            return {}
        has, many = np.unique(codes, return_counts=True)
        room: Counter[int] = Counter()
        for code, n in zip(has.tolist(), many.tolist(), strict=True):
            for k, most in self.holders[code]:
                room[k] += n if n < most else most
        out = {}
        for k, n in room.items():
            if n < self.least[k]:
                continue
            own = np.isin(codes, np.fromiter(self.counts[k], np.int64))
            if found := list(self.windows(k, both[own], codes[own])):
                out[k] = found, both[own], codes[own]
        return out

    def _named(self, found: list[tuple[tuple[float, int, int], int]]) -> list[tuple[str, float, int, int]]:
        found.sort(key=lambda x: (-x[0][0], -self.sizes[x[1]], self.names[x[1]], x[0][1]))
        return [(self.names[k], *window) for window, k in found]

    def scan(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """Template name, likeness, first bigram and end of the likest window of each template that has one, likest
        first."""
        return self._named([(max(found, key=lambda x: x[0]), k) for k, (found, *_) in self.candidates(text).items()])

    def resolve(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """Template name, likeness, first bigram and end of the windows that stay, likest first."""
        found = self.candidates(text)
        if not found:
            return []
        low = text.lower()
        spans = [m.span() for m in WORD.finditer(low)]
        queue = []
        starts: list[int] = []
        ends: list[int] = []
        kept = []

        def add(k: int, window: tuple[float, int, int]) -> None:
            like, a, b = window
            # bigrams in common less those of window and template that aren't
            score = round((1.5 * like - 1) * (b - a + self.sizes[k]))
            heapq.heappush(queue, (-score, -like, -self.sizes[k], self.names[k], a, window, k))

        def add_beside(k: int) -> None:
            _, at, codes = found[k]
            bounds = np.searchsorted(at, [0, *(x for y in zip(starts, ends, strict=True) for x in y), len(spans)])
            beside = [w for a, b in zip(bounds[::2], bounds[1::2], strict=True) for w in list(self.windows(k, at[a:b], codes[a:b]))[-1:]]
            if beside:
                add(k, max(beside, key=lambda x: x[0]))

        for k, (windows, *_) in found.items():
            for window in windows[-1:] if self.sizes[k] >= SHORT else windows:
                add(k, window)
        while queue:
            *_, window, k = heapq.heappop(queue)
            _, a, b = window
            at = bisect.bisect_left(ends, a + 1)
            free = at == len(starts) or starts[at] >= b
            if free and not self.same(k, low, spans[a][0], spans[b][1]):
                continue
            if free:
                starts.insert(at, a)
                ends.insert(at, b)
                kept.append((window, k))
            if self.sizes[k] >= SHORT:
                add_beside(k)
        return self._named(kept)

    def same(self, k: int, low: bytes, start: int, end: int) -> bool:
        """Whether a window names template k's variants and versions; a version goes on beyond the window's end."""
        creative = self.names[k].startswith("CC-BY")
        if self.sizes[k] >= SHORT and not creative:
            return True
        variants, versions = signature(low[start : re.compile(rb"(?:\.\d+)*").match(low, end).end()])
        return variants == self.signatures[k][0] and (self.sizes[k] >= SHORT or versions >= self.signatures[k][1])


def matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, like: float = LIKE) -> DataFrame:
    """doc_id, template, license, dice, start and end (bigram places) of every window that stays in docs (doc_id, text)."""
    schema = "doc_id long, template string, license string, dice double, start long, end long"
    return _map(docs, schema, templates, like, lambda doc_id, found: [(doc_id, x[0], x[0].partition("#")[0], *x[1:]) for x in found])


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, like: float = LIKE) -> DataFrame:
    """RESULT, one row a document: the likest licence (null if none), its likeness (0), and all that match."""

    def row(doc_id, found):
        names = sorted({x[0].partition("#")[0] for x in found})
        return [(doc_id, found[0][0].partition("#")[0] if found else None, found[0][1] if found else 0.0, len(names), ",".join(names))]

    return _map(docs, RESULT, templates, like, row)


def _map(docs: DataFrame, schema: str, templates: dict[str, str], like: float, rows) -> DataFrame:
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, like)
        for batch in batches:
            for some in common.slices(batch):
                out = [r for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True) for r in rows(doc_id, scanner.resolve(text))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8("text")).mapInArrow(run, schema)
