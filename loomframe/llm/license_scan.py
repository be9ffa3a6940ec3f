"""License notices in documents, found by conditional compression and confirmed word by word."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
#: What is looked for: fixed values, license texts and notices, and the wordings by which licenses are usually invoked.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (_APACHE, "Licensed under the Apache License, Version 2.0."),
    "BSD-2-Clause": (f"{_BSD_HEAD}\n{_BSD_TAIL}", "Licensed under the BSD 2-Clause License."),
    "BSD-3-Clause": (f"{_BSD_HEAD}\n{_BSD_THIRD}\n{_BSD_TAIL}", "Licensed under the BSD 3-Clause License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "GPL-2.0": (_GPL.format(2), "This work is licensed under the GNU General Public License, version 2."),
    "GPL-3.0": (_GPL.format(3), "This work is licensed under the GNU General Public License, version 3."),
    "ISC": (_ISC, "Licensed under the ISC License."),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (_MIT, "Released under the MIT License.", "Licensed under the MIT License."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Zlib": (_ZLIB,),
}
#: Cues: every template holds one.
CUE = r"(?i)licen[cs]|copyright|permission (is|to)|creative commons|\bcc0\b|\bcc[ -]by"
#: A block holds so many times the words of the longest template of its size, on either side of a cue.
AROUND = 1.2
#: Templates are of one size up to the next power of this many words.
SIZES = 4
#: Templates that save at least so much of what the best one saves are confirmed too.
MARGIN = 0.5
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(word: str) -> str:
    return re.sub(r"^\W+|\W+$", "", word.lower())


class NoticeFinder:
    """Templates as raw dictionaries of a zstandard compressor each."""

    def __init__(self, templates: dict[str, tuple[str, ...]]) -> None:
        import zstandard

        def compressor(**more) -> zstandard.ZstdCompressor:
            return zstandard.ZstdCompressor(level=19, write_content_size=False, write_checksum=False, write_dict_id=False, **more)

        self.alone = compressor()
        # by size: words around a cue, and templates
        self.sizes: dict[int, tuple[int, list]] = {}
        for name, wordings in templates.items():
            for wording in wordings:
                terms = [w for w in map(_plain, _WORD.findall(wording)) if w]
                raw = zstandard.ZstdCompressionDict(" ".join(terms).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                size = 1
                while size < len(terms):
                    size *= SIZES
                reach, group = self.sizes.get(size, (0, []))
                self.sizes[size] = (max(reach, round(AROUND * len(terms)) + 1), [*group, (name, terms, compressor(dict_data=raw))])
        self.known: dict[tuple[int, str], tuple | None] = {}

    def judge(self, terms: list[str], size: int, tolerance: float) -> tuple | None:
        """(license, share of the block's compressed size saved, differing words, first term, end term), or None."""
        block = " ".join(terms).encode()
        plain = len(self.alone.compress(block))
        templates = self.sizes[size][1]
        ranked = sorted(((1 - len(c.compress(block)) / plain, -i) for i, (_, _, c) in enumerate(templates)), reverse=True)
        best = None
        # as the winner is confirmed by wording, all templates that save a good part of what the first one does are looked at
        for saved, i in ranked:
            if saved < MARGIN * ranked[0][0] or saved <= 0:
                break
            name, wording, _ = templates[-i]
            matches = [m for m in SequenceMatcher(None, wording, terms, False).get_matching_blocks() if m.size]
            if not matches:
                continue
            start, end, differing = self._closest(matches, len(wording))
            if differing <= tolerance * len(wording) and (best is None or differing < best[2]):
                best = (name, saved, differing, start, end)
        return best

    @staticmethod
    def _closest(matches: list, wanted: int) -> tuple[int, int, int]:
        """Start, end and differing words of the run of matches in which the fewest words differ, stray matches left out."""
        best = (0, 0, wanted + 1)
        for i in range(len(matches)):
            same = 0
            for m in matches[i:]:
                same += m.size
                start, end = matches[i].b, m.b + m.size
                differing = max(wanted, end - start) - same
                if differing < best[2]:
                    best = (start, end, differing)
        return best

    def notices(self, text: str, tolerance: float) -> Iterator[tuple[str, float, int, int, int]]:
        """(license, saved, differing words, first character, end) of every notice in a text, none within another.

        Long templates come first. What isn't part of a notice is looked at again, before it and after it.
        """
        spans = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        starts = [a for a, _ in spans]
        cues = sorted({bisect_right(starts, m.start()) - 1 for m in re.finditer(CUE, text)})
        plain = {}
        free = [(0, len(spans))]  # words that no notice has
        out = []
        for size in sorted(self.sizes, reverse=True):
            reach = self.sizes[size][0]
            todo, free = free, []
            while todo:
                low, high = todo.pop()
                at = bisect_left(cues, low)
                found = None
                while found is None and at < len(cues) and cues[at] < high:
                    first, last = max(low, cues[at] - reach), min(high, cues[at] + reach)
                    words = [(i, w) for i in range(first, last) if (w := plain.setdefault(i, _plain(text[spans[i][0] : spans[i][1]])))]
                    key = (size, " ".join(w for _, w in words))
                    if key[1]:
                        if key not in self.known:
                            if len(self.known) > 100_000:
                                self.known.clear()
                            self.known[key] = self.judge([w for _, w in words], size, tolerance)
                        found = self.known[key]
                    at += 1
                if found is None:
                    free.append((low, high))
                    continue
                name, saved, differing, start, end = found
                a, b = words[start][0], words[end - 1][0]
                out.append((name, saved, differing, spans[a][0], spans[b][1]))
                todo += [(low, a), (b + 1, high)]
        yield from sorted(out, key=lambda n: n[3:])


def find_notices(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, tolerance: float = 0.15, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """License notices of every document: the id, license, saved, differing_words, start, end, wording.

    Around every cue word a block of words, as long as the templates of one size ask for, is compressed alone and with
    each of these as raw dictionary; they are ranked by the share of bytes saved, and of those that save ``MARGIN`` of the
    best saving or more the one with the fewest differing words is accepted if at most ``tolerance`` of its words differ.
    Notices don't overlap; every cue that lies in none is looked at; a notice without any cue word isn't seen. start and end count characters. Null and empty texts and those without a cue have no rows; a null id
    is kept; repeated rows give repeated results; an empty table none. Whole texts are searched; no shuffle.
    """
    schema = T.StructType([docs.schema[id_column], *T.StructType.fromDDL("license string, saved double, differing_words int, start int, end int, wording string").fields])
    given = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = NoticeFinder(given)
        for batch in batches:
            at, rows = [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                for name, saved, differing, a, b in finder.notices(body, tolerance):
                    at.append(i)
                    rows.append((name, saved, differing, a, b, body[a:b]))
            if rows:
                kinds = (pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=schema.names)

    return docs.where(F.col(text).rlike(CUE)).select(id_column, text).mapInArrow(run, schema)
