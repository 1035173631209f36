"""Licence scan: passages against licence templates by Dice coefficient over word bigrams.

Text is normalised to lower-case words of letters and digits. A passage is the whole text, a run of
consecutive lines, or a window of words within a line that begins and ends with the first and last two
words of a template. With at least ``least`` = t of 2 |A and B| / (|A| + |B|), where A and B are multisets
of bigrams (a single word counts as one), a passage of a bigrams can only match templates with
t a / (2 - t) to (2 - t) a / t bigrams, and at least t / (2 - t) of its own bigrams must occur in some
template. The first bound prunes templates and ends runs of lines, the second skips prose. A run also ends
once less than t / 2 of its bigrams occur in any template: without such a beginning it would match better.

The best match of every place counts: matches do not overlap, better ones go first, then longer, earlier
and by name. The templates are a fixed list that does not grow with the data, so the scan is one pass
over the texts without a shuffle.

Defined results: null and empty texts match nothing; repeated rows are reported each for themselves; an
empty table gives no rows; other columns are not looked at.
"""

import pkgutil
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from almsbook.llm.common import id_and_text, per_text

WORD = re.compile(r"[a-z0-9]+")
MATCHES = pa.schema([
    ("doc_id", pa.int64()), ("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())
])

def full_text(name: str) -> str:
    return pkgutil.get_data("almsbook.llm", f"licenses/{name}.txt").decode()


BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
    "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
    "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def program_header(what: str, license: str, version: str) -> str:
    return (
        f"This {what} is free software; you can redistribute it and/or modify it under the terms of the {license} as published by the Free "
        f"Software Foundation; either version {version} of the License, or (at your option) any later version. This {what} is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        f"PARTICULAR PURPOSE. See the {license} for more details."
    )


# Short notices, headers and full texts of common public licences. There is no full text of the AGPL.
TEMPLATES = {
    "mit-notice": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license."],
    "apache-2.0-notice": ["Licensed under the Apache License, Version 2.0.", "This project is licensed under the Apache License 2.0."],
    "gpl-3.0-notice": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "gpl-2.0-notice": [
        "This work is licensed under the GNU General Public License, version 2.", program_header("program", "GNU General Public License", "2"),
    ],
    "lgpl-notice": [
        "This library is licensed under the GNU Lesser General Public License.",
        program_header("library", "GNU Lesser General Public License", "2.1"), program_header("library", "GNU Lesser General Public License", "3"),
    ],
    "agpl-3.0-notice": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        program_header("program", "GNU Affero General Public License", "3"),
    ],
    "bsd-notice": ["Licensed under the BSD License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "bsd-2-clause": [BSD_CONDITIONS + BSD_DISCLAIMER],
    "bsd-3-clause": [BSD_CONDITIONS + BSD_NAMES + BSD_DISCLAIMER],
    "apache-2.0": [full_text("Apache-2.0")],
    "gpl-2.0": [full_text("GPL-2")],
    "gpl-3.0": [full_text("GPL-3")],
    "lgpl-2.1": [full_text("LGPL-2.1")],
    "lgpl-3.0": [full_text("LGPL-3")],
    "mpl-2.0": [full_text("MPL-2.0")],
    "cc-by-nc-4.0-notice": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-4.0-notice": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-4.0-notice": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0-header": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "mpl-2.0-header": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
        "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must "
        "be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution.",
    ],
    "0bsd": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ],
}


def words_in(text: str) -> list[str]:
    return WORD.findall(text.lower())


def bigrams(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(words[:-1], words[1:], strict=True)) or [(w,) for w in words]


def dice(a: Counter, size_a: int, b: Counter, size_b: int) -> float:
    return 2 * sum((a & b).values()) / (size_a + size_b)


class Scanner:
    """Templates in order of size, and every bigram that any of them has."""

    def __init__(self, templates: dict[str, list[str]], least: float) -> None:
        known = [(name, bigrams(words_in(text))) for name, texts in templates.items() for text in texts]
        self.templates = sorted((len(pairs), name, Counter(pairs)) for name, pairs in known if pairs)
        self.sizes = [size for size, _, _ in self.templates]
        self.vocabulary = {pair for _, _, pairs in self.templates for pair in pairs}
        # Per bigram the templates that hold it, and how often; per first two words the templates, with their last two.
        self.holders: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for k, (_, _, pairs) in enumerate(self.templates):
            for pair, times in pairs.items():
                self.holders.setdefault(pair, []).append((k, times))
        self.begins: dict[tuple[str, ...], set] = {}
        for name, pairs in known:
            if pairs:
                at = self.templates.index((len(pairs), name, Counter(pairs)))
                self.begins.setdefault(pairs[0], set()).add((at, pairs[-1]))
        self.singles = {w for pair in self.vocabulary for w in pair}
        self.least = least
        self.most = self.sizes[-1] * (2 - least) / least if self.sizes else 0

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """Dice and name of the best template for a passage; ties go to the smaller name."""
        pairs = bigrams(words)
        n, t = len(pairs), self.least
        lo, hi = bisect_left(self.sizes, n * t / (2 - t) - 1e-9), bisect_right(self.sizes, n * (2 - t) / t + 1e-9)
        if not n or lo >= hi:
            return None
        own = Counter(pairs)
        score, name = min((-dice(own, n, c, size), name) for size, name, c in self.templates[lo:hi])
        return (-score, name) if -score >= t else None

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        if not text or not self.templates:
            return []
        lines = [words_in(line) for line in text.split("\n")]
        hot = [i for i, words in enumerate(lines) if words and not self.singles.isdisjoint(words)]
        if not hot:
            return []
        off = [0, *accumulate(map(len, lines))]
        words = [w for line in lines for w in line]
        pairs = list(zip(words[:-1], words[1:], strict=True))
        holders = list(map(self.holders.get, pairs))
        ends, found, t = set(hot), [], self.least
        for first in hot:
            start = at = off[first]
            own: Counter = Counter()
            common = [0] * len(self.templates)
            shared = 0
            for last in range(first, len(lines)):
                n = off[last + 1] - start - 1
                if n > self.most:
                    break
                for at in range(at, off[last + 1] - 1):
                    if holders[at]:
                        shared += 1
                        own[pairs[at]] += 1
                        times = own[pairs[at]]
                        for k, most in holders[at]:
                            if times <= most:
                                common[k] += 1
                at = max(start, off[last + 1] - 1)
                if shared < n * t / 2 - 2:
                    break
                if last not in ends or shared < n * t / (2 - t):
                    continue
                match = self.nearest(common, n) if n else self.best(words[start : start + 1])
                if match:
                    found.append((-match[0], first - last, first, start, match[1], last, off[last + 1]))
        if sum(map(bool, holders)) >= len(pairs) * t / (2 - t) and (whole := self.best(words)):
            found.append((-whole[0], 1 - len(lines), 0, 0, whole[1], len(lines) - 1, len(words)))
        for line in hot:
            found.extend(self.windows(pairs, line, off[line], off[line + 1]))
        out: list[tuple] = []
        for score, _, first, start, name, last, end in sorted(found):
            if all(end <= a or start >= b for a, b, *_ in out):
                out.append((start, end, name, -score, first, last))
        return [match[2:] for match in sorted(out)]

    def nearest(self, common: list[int], n: int) -> tuple[float, str] | None:
        """As ``best`` for a passage of ``n`` bigrams, from those it has in common with each template."""
        t = self.least
        lo, hi = bisect_left(self.sizes, n * t / (2 - t) - 1e-9), bisect_right(self.sizes, n * (2 - t) / t + 1e-9)
        score, name = min(((-2 * common[k] / (n + self.sizes[k]), self.templates[k][1]) for k in range(lo, hi)), default=(0.0, ""))
        return (-score, name) if -score >= t else None

    def windows(self, pairs: list[tuple[str, str]], line: int, start: int, end: int) -> list[tuple]:
        """Matches of windows of words within a line, without the whole line."""
        found, t = [], self.least
        for a in range(start, end - 1):
            for k, closing in self.begins.get(pairs[a], ()):
                size, name, wanted = self.templates[k]
                own: Counter = Counter()
                common = 0
                for b in range(a, min(end - 1, a + int(size * (2 - t) / t + 1e-9))):
                    own[pairs[b]] += 1
                    common += own[pairs[b]] <= wanted[pairs[b]]
                    n = b - a + 1
                    if common < n * t / 2 - 2:
                        break
                    if pairs[b] == closing and 2 * common / (n + size) >= t and (a, b + 2) != (start, end):
                        found.append((-2 * common / (n + size), 0, line, a, name, line, b + 2))
        return found


@cache
def default_scanner(least: float) -> Scanner:
    return Scanner(TEMPLATES, least)


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, license, dice, first_line, last_line)`` of every licence passage."""
    own = Scanner(templates, least) if templates is not None else None

    def rows(doc_id, text):
        return [(doc_id, *match) for match in (own or default_scanner(least)).scan(text)]

    return id_and_text(docs, id_col, text_col).mapInArrow(
        per_text(rows, MATCHES), "doc_id long, license string, dice double, first_line int, last_line int"
    )
