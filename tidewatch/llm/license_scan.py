"""License scans: normalised text against templates by the Dice coefficient.

A text is normalised to lower-case words (ASCII punctuation separates words,
so ``CC BY-NC 4.0.`` reads ``cc by nc 4 0``). Candidate segments are every
line, every sentence within a line, every paragraph (lines up to an empty one)
and the whole text. A segment is compared to a template by the Dice
coefficient over the sets of word bigrams; 2 * min / (sum of sizes) bounds it,
so only templates of a fitting size are compared at all.

Defined cases: null and empty texts, and texts of one word, have no notices;
an empty table gives an empty result; repeated rows give one row each; ties
go to the alphabetically first license; other columns are ignored, so
clashing names do no harm; null ids are carried through. An empty template
list gives documents without notices.
"""

from __future__ import annotations

import re
import string

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import as_bytes, batches, schema_of, table_batch

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE.")
_BSD_3 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.")
_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.",
        "You should have received a copy of the GNU {1} along with this {0}. If not, see https://www.gnu.org/licenses/.")
_GPL = tuple(p.format("program", "General Public License") for p in _GNU)
_LGPL = tuple(p.format("library", "Lesser General Public License") for p in _GNU)
_MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",)

#: Whole licence texts and whole standard headers by their paragraphs.
WHOLE: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", _MIT), ("BSD-3-Clause", _BSD_3), ("Apache-2.0", _APACHE), ("GPL-3.0", _GPL), ("LGPL-3.0", _LGPL),
    ("MPL-2.0", _MPL))

# Short notices as the licenses' own publishers word them, the
# whole texts, and the paragraph of each by which it is known where paragraphs
# are set apart.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    *((name, " ".join(parts)) for name, parts in WHOLE),
    *((name, parts[0]) for name, parts in WHOLE if len(parts) > 1),
)

#: Licenses whose texts a corpus may not use freely.
RESTRICTED = ("CC-BY-NC-4.0", "GPL-3.0", "LGPL-3.0", "LicenseRef-all-rights-reserved")

_CLEAN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_SENTENCE = re.compile(rb"[.!?]+[ \t]+")
_PARAGRAPH = re.compile(rb"\n[ \t]*\n")


def normalise(text: bytes) -> list[bytes]:
    return text.lower().translate(_CLEAN).split()


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


class Scanner:
    """Compares segments with templates whose Dice coefficient can reach ``least``."""

    def __init__(self, templates, least: float):
        self.least = least
        self.templates = sorted((len(b), name, b) for name, text in templates if (b := bigrams(normalise(text.encode()))))
        self.words = {w: i + 1 for i, w in enumerate(sorted({w for _, _, b in self.templates for pair in b for w in pair}))}
        self.width = len(self.words) + 1
        self.known = np.zeros(self.width * self.width, bool)
        for _, _, grams in self.templates:
            for a, b in grams:
                self.known[self.words[a] * self.width + self.words[b]] = True
        sizes = [n for n, _, _ in self.templates]
        self.smallest = min(sizes, default=0) * least / (2 - least)
        self.largest = max(sizes, default=0) * (2 - least) / least

    def hits(self, words: list[bytes]) -> int:
        """Word pairs of the sequence that stand in any template."""
        get = self.words.get
        codes = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        return int(self.known[codes[:-1] * self.width + codes[1:]].sum()) if len(words) > 1 else 0

    def best(self, words: list[bytes]) -> tuple[float, str] | None:
        """(Dice, license) of the nearest template at ``least`` or more."""
        if len(words) <= self.smallest or self.hits(words) < self.smallest * self.least:
            return None
        grams, found = bigrams(words), None
        for size, name, template in self.templates:
            if 2 * min(size, len(grams)) < self.least * (size + len(grams)):
                continue
            dice = 2 * len(grams & template) / (size + len(grams))
            if dice >= self.least and (found is None or (-dice, name) < found):
                found = (-dice, name)
        return found and (-found[0], found[1])

    def segments(self, text: bytes):
        for line in text.split(b"\n"):
            if self.hits(normalise(line)):
                yield line
                parts = _SENTENCE.split(line)
                if len(parts) > 1:
                    yield from parts
        paragraphs = _PARAGRAPH.split(text) if b"\n" in text else []
        for p in paragraphs:
            if b"\n" in p.strip(b"\n"):
                yield p
        if len(paragraphs) > 1:
            yield text

    def scan(self, text: bytes) -> list[tuple[str, float, bytes]]:
        """One (license, Dice, segment) for each license found, its best one."""
        if self.hits(normalise(text)) == 0:
            return []
        found: dict[str, tuple[float, bytes]] = {}
        for segment in self.segments(text):
            words = normalise(segment)
            if len(words) - 1 > self.largest and len(bigrams(words)) > self.largest:
                continue
            if (best := self.best(words)) and best[0] > found.get(best[1], (0.0, b""))[0]:
                found[best[1]] = (best[0], segment)
        return [(name, dice, segment) for name, (dice, segment) in sorted(found.items())]


def scan(docs: DataFrame, templates=TEMPLATES, least: float = 0.8, text_col: str = "text",
         id_col: str = "doc_id") -> DataFrame:
    """One row per document with its notices: array of (license, dice, segment)."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    notice = "array<struct<license: string, dice: double, segment: string>>"
    spark_schema, arrow = schema_of(f"id {frame.schema['id'].dataType.simpleString()}, n_words long, notices {notice}")

    def run(it):
        scanner = Scanner(templates, least)
        for b in batches(it):
            texts = as_bytes(b.column("text"))
            found = [[{"license": n, "dice": d, "segment": s.decode(errors="replace")} for n, d, s in scanner.scan(t)]
                     for t in texts]
            yield table_batch({"id": b.column("id"), "n_words": [len(t.split()) for t in texts], "notices": found}, arrow)

    return frame.mapInArrow(run, spark_schema).withColumnRenamed("id", id_col)


def op10_license_scan(docs: DataFrame) -> DataFrame:
    names = F.transform("notices", lambda x: x["license"])
    return scan(docs).select(
        "doc_id", "n_words", F.size("notices").alias("n_notices"), F.concat_ws(",", names).alias("licenses"),
        F.array_max(F.transform("notices", lambda x: x["dice"])).alias("best_dice"),
        F.arrays_overlap(names, F.array(*map(F.lit, RESTRICTED))).alias("restricted"))
