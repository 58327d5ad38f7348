"""License scans by conditional compression.

A text is cut into sentences and lines.  Runs of units with a licensing cue and
mostly licence vocabulary are candidate blocks.  Each block is compressed
plainly and with every template as zstandard raw dictionary; templates are
ranked by the bytes they save, and the best ``confirm`` of them are confirmed by
the exact difference in words between the block and the span of the template
it follows.

Plan: one map-only pass; nothing is shuffled or collected.  Templates are a
parameter; a task holds them as compressors once.

Edge cases: null or empty texts have no blocks; a block of any length is judged
whole; repeated rows are reported alike; ties of saved bytes go to the smaller word difference, then to the name; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcore import slices

#: Usual notices and opening words of public licences, and the whole texts of the short ones.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
        'written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
        "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
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
}

_CUE = re.compile(r"(?i)licen[sc]e|copyright|permission is|redistribut|warrant(?:y|ies)|creative commons|public domain")
_UNIT = re.compile(r"[^\n]+?(?:[.!?;:](?=\s)|(?=\n)|\Z)", re.S)
_WORD = re.compile(r"\w+(?:[.-]\w+)*")

SCHEMA = (
    "doc_id long, block int, start long, length long, license string, saved_bytes int, plain_bytes int, "
    "missing_words int, extra_words int, confirmed boolean, runner_up string"
)


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def blocks(text: str, vocabulary: set[str]) -> list[tuple[int, int]]:
    """(start, end) of candidate blocks: runs of units in licence vocabulary that open with a cue.

    Short units without a cue end no run: prose of a few common words is not part of a notice.
    """
    if not _CUE.search(text):
        return []
    out, run = [], None
    for m in _UNIT.finditer(text):
        own = words_of(m[0])
        if not own:
            continue
        inside = 5 * sum(w in vocabulary for w in own) >= 3 * len(own)
        if inside and (_CUE.search(m[0]) or run and len(own) >= 6):
            run = [run[0] if run else m.start(), m.end()]
        elif not inside and run:
            out.append(run)
            run = None
    if run:
        out.append(run)
    parts = []
    for a, z in out:
        a += len(text[a:z]) - len(text[a:z].lstrip())
        if _CUE.search(text, a, z):
            parts.append((a, z))
    return parts


def difference(block: list[str], template: list[str]) -> tuple[int, int]:
    """(template words missing from the block, block words extra to it) over the span of the template that the block follows.

    A block of more than 20 times the template's words is never confirmed; its words are only counted, not aligned.
    """
    if len(block) > 20 * len(template):
        same = sum((Counter(template) & Counter(block)).values())
        return len(template) - same, len(block) - same
    matched = [m for m in SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
    if not matched:
        return len(template), len(block)
    same = sum(m.size for m in matched)
    span = matched[-1].a + matched[-1].size - matched[0].a
    return span - same, len(block) - same


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]], confirm: int):
        import zstandard

        self.items = [(name, words_of(text), text) for name, own in sorted(templates.items()) for text in own]
        self.vocabulary = {w for _, own, _ in self.items for w in own}
        dictionary = lambda t: zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.plain = zstandard.ZstdCompressor(level=12)
        self.given = [zstandard.ZstdCompressor(level=12, dict_data=dictionary(" " * 8 + text)) for _, _, text in self.items]
        self.confirm = confirm

    def judge(self, block: str) -> tuple:
        data = block.encode()
        plain = len(self.plain.compress(data))
        own = words_of(block)
        ranked = sorted((len(c.compress(data)) - plain, k) for k, c in enumerate(self.given))
        edge = ranked[min(self.confirm, len(ranked)) - 1][0] if ranked else 0
        tried = []
        for less, k in ranked:
            if less > edge:  # templates that save as much as the last are tried too
                break
            missing, extra = difference(own, self.items[k][1])
            sure = less < 0 and 10 * (missing + extra) <= len(own) and len(own) - extra >= 4
            tried.append((not sure, missing + extra, less, self.items[k][0], missing, extra))
        best = min(tried)
        other = next((t[3] for t in sorted(tried) if t[3] != best[3]), None)
        return best[3], -best[2], plain, best[4], best[5], not best[0], other


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, confirm: int = 4) -> DataFrame:
    """One row for each candidate block of each document, with its best template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, confirm)
        for batch in slices(batches, "text"):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, (a, z) in enumerate(blocks(text or "", scanner.vocabulary)):
                    rows.append((doc, k, a, z - a, *scanner.judge(text[a:z])))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), *[pa.int32()] * 4, pa.bool_(), pa.string())
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return scan(read(spark, sf_dir, "documents"))
