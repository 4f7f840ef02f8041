"""Licence notices in documents, by the Dice coefficient over word bigrams.

Templates are notices (one line or a paragraph), and whole texts: MIT, ISC, BSD-2-Clause and BSD-3-Clause here, Apache-2.0,
GPL-2.0, GPL-3.0, LGPL-2.1, LGPL-3.0, MPL-2.0 and CC0-1.0 as files; AGPL-3.0 and the CC-BY family are known by notice only.
Texts and templates are normalised alike: A-Z lower-cased, and everything but letters, digits and non-ASCII bytes
is blank. A passage matches a template if twice the number of shared distinct bigrams over the sum of both numbers
reaches the threshold t. Three bounds leave few passages to compare:

* only bigrams of a template count, and a best passage starts and ends with one;
* a passage has at most (2 - t) / t times the template's bigrams (and at least t / (2 - t) times), and runs over no
  more than twice as many words: one that repeats itself more is not a notice;
* it shares at least t / (2 - t) of the template's bigrams, so as many hits must lie within the longest passage.

Of overlapping matches the one of highest Dice coefficient stays (then the longer template, the earlier
passage, the name), so a document can hold several licences, and each of them several times.

Defined cases: a null or empty text, and one of a single word, holds nothing; repeated rows are scanned each; an
empty table gives no rows; other columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import cache
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.words import gram_hashes, word_hashes

THRESHOLD = 0.8

# Clauses of the BSD licences.
_BSD_FIRST = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer."
)
_BSD_SECOND = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_LAST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)

# Public licence notices by SPDX name, and whole texts of the short licences. Year and holder are left out.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; version 2.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        f"{_BSD_FIRST} {_BSD_SECOND} {_BSD_LAST}",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        f"{_BSD_FIRST} {_BSD_SECOND} 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        f"endorse or promote products derived from this software without specific prior written permission. {_BSD_LAST}",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "all-rights-reserved": ("All rights reserved.",),
}


def whole_texts() -> dict[str, tuple[str, ...]]:
    """The licences whose whole text is a file of this package (``licence_texts``), by SPDX name."""
    found = files(__package__).joinpath("licence_texts").iterdir()
    return {x.name.removesuffix(".txt"): (x.read_text(encoding="utf-8"),) for x in found if x.name.endswith(".txt")}


@cache
def known_templates() -> dict[str, tuple[str, ...]]:
    """Notices first, then whole texts."""
    texts = whole_texts()
    return {x: TEMPLATES.get(x, ()) + texts.get(x, ()) for x in sorted({*TEMPLATES, *texts})}

_NORMAL = bytes(
    x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or 48 <= x <= 57 or x >= 128 else 32 for x in range(256)
)
_BLOCK = 1 << 22  # bytes


def bigrams(data: bytes) -> np.ndarray:
    """A hash for each two words that follow each other in the normalised text; long texts are hashed block by
    block, cut at blanks."""
    data = data.translate(_NORMAL)
    parts, start = [], 0
    while len(data) - start > _BLOCK and (end := data.find(b" ", start + _BLOCK)) >= 0:
        parts.append(word_hashes(data[start:end]))
        start = end
    words = np.concatenate([*parts, word_hashes(data[start:])])
    return gram_hashes(words, 2) if len(words) > 1 else np.empty(0, dtype=np.uint64)


def _before(grams: np.ndarray) -> np.ndarray:
    """Where each bigram occurred last before; -1 at its first place."""
    order = np.argsort(grams, kind="stable")
    out = np.full(len(grams), -1)
    same = grams[order[1:]] == grams[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


class Scanner:
    """Finds the passages of a text that match a template; see the module."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.templates = [
            (name, number, np.unique(bigrams(text.encode())))
            for name, texts in sorted((known_templates() if templates is None else templates).items()) for number, text in enumerate(texts)
        ]
        self.every = np.unique(np.concatenate([x for *_, x in self.templates]))
        self.member = np.array([np.isin(self.every, x) for *_, x in self.templates])
        low = threshold / (2 - threshold)
        self.bounds = [(math.ceil(low * len(x) - 1e-9), math.floor(len(x) / low + 1e-9)) for *_, x in self.templates]
        self.least = np.array([x for x, _ in self.bounds])

    def _matches(self, grams: np.ndarray) -> list[tuple[float, int, int, int]]:
        """Dice coefficient, first bigram, end and template of the best passage from each start."""
        place = np.minimum(np.searchsorted(self.every, grams), len(self.every) - 1)
        hits = np.flatnonzero(self.every[place] == grams)
        found, before = [], None
        if not len(hits):
            return found
        # Templates that the text has too few bigrams of, each bigram counted as often as it occurs, are out.
        few = np.flatnonzero(self.least <= len(hits))
        own_hits = self.member[np.ix_(few, place[hits])]
        for number, mine in zip(few.tolist(), own_hits):
            (least, most), size = self.bounds[number], len(self.templates[number][2])
            at = hits[mine]
            if len(at) < least:
                continue
            # Enough hits within reach: a passage that repeats bigrams may have twice as many as distinct ones.
            near = np.flatnonzero(at[least - 1:] - at[:len(at) - least + 1] < 2 * most)
            if len(near) and before is None:
                before = _before(grams)
            for k in near.tolist():
                if (match := self._best_end(before, at, k, size, most)) is not None:
                    found.append((*match, number))
        return found

    def _best_end(self, before: np.ndarray, at: np.ndarray, k: int, size: int, most: int):
        """The passage of most Dice coefficient, of equal ones the longest, that starts at hit ``k``."""
        start = int(at[k])
        ends = at[k:k + np.searchsorted(at[k:], start + 2 * most)]
        new = before[start:int(ends[-1]) + 1] < start  # bigrams that are not in the passage before
        seen = np.cumsum(new)[ends - start]
        shared = np.cumsum(new[ends - start])
        dice = np.where(seen <= most, 2 * shared / (seen + size), 0.0)
        best = len(dice) - 1 - int(dice[::-1].argmax())
        return (float(dice[best]), start, int(ends[best]) + 1) if dice[best] >= self.threshold else None

    def scan(self, text: str) -> list[tuple[str, int, float, int, int]]:
        """licence, template, dice, first word and number of words of every passage that matches."""
        grams = bigrams(text.encode())
        taken: list[tuple[int, int]] = []
        out = []
        order = sorted(self._matches(grams), key=lambda x: (-x[0], -len(self.templates[x[3]][2]), x[1], x[2], x[3]))
        for dice, start, end, number in order:
            if all(end < a or start > b for a, b in taken):  # words: a bigram's second word belongs to it
                taken.append((start, end))
                name, which, _ = self.templates[number]
                out.append((name, which, dice, start, end - start + 1))
        return sorted(out, key=lambda x: x[3])


def scan_documents(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, licence, template (its number among the licence's), dice, first_word, n_words of every match.
    Words are those of the normalised text, from 0."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("licence", pa.string()), ("template", pa.int32()), ("dice", pa.float64()),
        ("first_word", pa.int64()), ("n_words", pa.int64()),
    ])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                for match in scanner.scan(text.as_py() or "")
            ]
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    kinds = "doc_id long, licence string, template int, dice double, first_word long, n_words long"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(scanned, kinds)
