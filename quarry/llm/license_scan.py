"""Licence scans: the Dice coefficient of word bigrams against templates.

The text is cut into segments at ends of lines and sentences, after
lower-casing, dropping punctuation and copyright lines. Compared are runs of
consecutive segments, so sentences, lines, paragraphs and several of them, as
well as sentences wrapped over lines. With ``a`` and ``b`` distinct bigrams, a
coefficient of at least ``threshold`` needs ``b >= a * threshold / (2 -
threshold)`` and the reverse, and as many shared ones. An inverted index of the
templates' bigrams gives the templates that share enough with the whole text;
for each of them, runs are tried that begin and end where it has bigrams and
that are not too large for it. Of the runs with one beginning the best end
counts, and of the templates that fit a run the one with the highest
coefficient. A place that lies by half or more in a better place of another
licence is not reported: the notices of related licences differ in a few words.

One pass of ``mapInArrow`` over whole texts, without a shuffle; the templates are
a parameter of the job.

Defined results: null and empty texts have no licence; each pair of document and
licence is reported once, at its best, then first, then longest place; repeated rows are
reported as often as they occur; a very long text is compared in all its places; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column_of

THRESHOLD = 0.8

# Names of public licences, and the beginnings of licence texts
# and notices as their authors publish them.
NAMES = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": [
        "CC BY-NC-SA 4.0",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "Unlicense": ["The Unlicense"],
    "Zlib": ["zlib License"],
}
NOTICES = [
    "Licensed under {}",
    "Licensed under the {}",
    "Released under the {}",
    "Distributed under the {}",
    "Available under the {}",
    "This work is licensed under {}",
    "This work is licensed under the {}",
    "This project is licensed under the {}",
    "This file is licensed under the {}",
]
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
        ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
        USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
        OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
        the GNU General Public License for more details.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
        authors be held liable for any damages arising from the use of this software. Permission is granted to
        anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
        misrepresented; you must not claim that you wrote the original software. If you use this software in a
        product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
        source versions must be plainly marked as such, and must not be misrepresented as being the original
        software. 3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
        TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
        WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright
        holder nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
        USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
        THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
        the GNU General Public License for more details.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the
        License, or (at your option) any later version. This library is distributed in the hope that it will be
        useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "LGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU Lesser General Public License for more details.""",
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU Affero General Public License for more details.""",
    "CC0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and
        neighboring rights to this software to the public domain worldwide. This software is distributed without any
        warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software. If
        not, see <http://creativecommons.org/publicdomain/zero/1.0/>.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that
        recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
        the software to the public domain. We make this dedication for the benefit of the public at large and to the
        detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in
        perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For
        more information, please refer to <https://unlicense.org>""",
}

_WORD = re.compile(r"[a-z0-9]+(?:[.+][a-z0-9]+)*")
# Not the lines of a wrapped text that happen to begin with "copyright holders" and the like.
_COPYRIGHT = re.compile(
    r"(?m)^[ \t]*(?:copyright(?!\s+(?:holders?|owners?|notices?|laws?|interests?|licen[cs]es?|and|or|in)\b)|\(c\)|©).*$"
)
# Up to the end of a line or sentence; a dot within a word does not end one.
_SEGMENT = re.compile(r"[^.!?\n]+(?:[.!?](?=\S)[^.!?\n]*)*[.!?]*")


def default_templates() -> list[tuple[str, str]]:
    found = [(name, text) for name, text in TEXTS.items()]
    return found + [(k, notice.format(n)) for k, names in NAMES.items() for n in names for notice in NOTICES]


def bigrams(lowered: str) -> set[tuple[str, str]]:
    words = _WORD.findall(lowered)
    return set(zip(words, words[1:], strict=False))


def normalise(text: str) -> str:
    """Lower case, with copyright lines blanked out in place."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a few letters grow in lower case; keep places
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return _COPYRIGHT.sub(lambda m: " " * len(m.group()), lowered)


class Templates:
    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        self.sets = sets = [bigrams(normalise(text)) for _, text in templates]
        self.sizes = [len(s) for s in sets]
        self.index: dict[tuple[str, str], list[int]] = {}
        for i, s in enumerate(sets):
            for b in s:
                self.index.setdefault(b, []).append(i)
        ratio = (2 - threshold) / threshold * (1 + 1e-9)
        self.least, self.most = min(self.sizes) / ratio, max(self.sizes) * ratio
        self.ratio = ratio

    def shared(self, found: set[tuple[str, str]]) -> dict[int, int]:
        """The number of bigrams that each template shares with ``found``."""
        counts: dict[int, int] = {}
        for b in found & self.index.keys():
            for i in self.index[b]:
                counts[i] = counts.get(i, 0) + 1
        return counts

    def best(self, found: set[tuple[str, str]]) -> tuple[float, str] | None:
        n = len(found)
        if not self.least <= n <= self.most:
            return None
        best = None
        for i, k in self.shared(found).items():
            size = self.sizes[i]
            if n <= size * self.ratio and size <= n * self.ratio:
                dice = 2 * k / (n + size)
                if dice >= self.threshold and (best is None or (-dice, self.names[i]) < (-best[0], best[1])):
                    best = dice, self.names[i]
        return best

    def runs(self, i: int, pairs: list[tuple[str, str]], ends: list[int]) -> Iterator[tuple[int, int]]:
        """First and last segment of the best run for template ``i`` from each
        beginning. ``ends``: for each segment, the number of words up to its end.

        A run whose first segment shares nothing that is not shared again later
        in it is no better than the run without that segment, so extending stops
        there; repeated lines stay cheap."""
        template, size = self.sets[i], self.sizes[i]
        places = [j for j, p in enumerate(pairs) if p in template]
        # Segments that hold the first word, and those that hold the second word, of a shared bigram.
        firsts = sorted({bisect_left(ends, j + 1) for j in places})
        lasts = sorted({bisect_left(ends, j + 2) for j in places})
        most = size * self.ratio
        for first in firsts:
            begin = ends[first - 1] if first else 0
            seen: set[tuple[str, str]] = set()
            k, j, best = 0, begin, None
            head = {p for p in pairs[begin : ends[first]] if p in template}
            for last in lasts[bisect_left(lasts, first) :]:
                for p in pairs[j : ends[last] - 1]:
                    if j >= ends[first]:
                        head.discard(p)
                    if p not in seen:
                        seen.add(p)
                        k += p in template
                        if len(seen) > most:
                            break
                    j += 1
                if len(seen) > most:
                    break
                dice = 2 * k / (len(seen) + size)
                if dice >= self.threshold and (best is None or dice >= best[0]):
                    best = dice, last
                if not head:
                    break
            if best:
                yield first, best[1]

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """``license, dice, start, length`` (code points), best place per licence."""
        lowered = normalise(text)
        words = _WORD.findall(lowered)
        pairs = list(zip(words, words[1:], strict=False))
        likely = [i for i, k in self.shared(set(pairs)).items() if k * self.ratio >= self.sizes[i]]
        if not likely:
            return []
        spans, ends = [], []
        starts = [m.start() for m in _WORD.finditer(lowered)]
        for m in _SEGMENT.finditer(lowered):
            n = bisect_left(starts, m.end())
            if n > (ends[-1] if ends else 0):  # segments without words are passed over
                spans.append(m.span())
                ends.append(n)
        hits = set()
        for first, last in {run for i in likely for run in self.runs(i, pairs, ends)}:
            hit = self.best(set(pairs[ends[first - 1] if first else 0 : ends[last] - 1]))
            if hit:
                start, end = spans[first][0], spans[last][1]
                hits.add((-hit[0], start, start - end, hit[1]))
        places: list[tuple[int, int, str]] = []
        found: dict[str, tuple[float, int, int]] = {}
        for cost, start, less, name in sorted(hits):
            end = start - less
            if any(n != name and 2 * (min(end, e) - max(start, s)) >= end - start for s, e, n in places):
                continue
            if not any(n == name and s <= start and end <= e for s, e, n in places):
                places.append((start, end, name))
            found.setdefault(name, (cost, start, less))
        return [(name, -s[0], s[1], -s[2]) for name, s in sorted(found.items())]


def scan_licenses(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document and licence found: ``doc_id, license, dice, start,
    length`` (in code points)."""
    known = Templates(templates if templates is not None else default_templates(), threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = column_of(batch, "doc_id").to_pylist()
            rows = [
                (doc_id, *hit)
                for doc_id, text in zip(doc_ids, column_of(batch, "text"), strict=True)
                for hit in known.scan(text.as_py() or "")
            ]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                ["doc_id", "license", "dice", "start", "length"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, license string, dice double, start bigint, length bigint"
    )
