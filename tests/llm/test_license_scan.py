from brandspark.llm.common import read
from brandspark.llm.license_scan import TEMPLATES, blocks, difference, scan, words_of


def one(spark, texts, **parameters):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, license string")
    return sorted(scan(docs, **parameters).collect(), key=lambda r: (r.doc_id, r.block))


def test_every_template_confirms_itself(spark):
    texts = [f"Erhe ththat nding.\n{t}\nOther prose follows here." for own in TEMPLATES.values() for t in own]
    names = [name for name, own in TEMPLATES.items() for _ in own]
    got = one(spark, texts)
    assert [r.license for r in got] == names
    assert all(r.confirmed and r.missing_words + r.extra_words == 0 for r in got)


def test_wording_difference_decides(spark):
    near = "This work is licensed under the GNU General Public License, version 2."
    far = "You must buy a commercial license from us before you copy this work."
    a, *rest = one(spark, [near, far, "No notice at all.", None, ""])
    assert a.license == "GPL-2.0" and a.runner_up == "GPL-3.0" and a.confirmed
    assert not any(r.confirmed for r in rest)


def test_edges(spark):
    mit = TEMPLATES["MIT"][1]
    got = one(spark, [mit * 60, "x" * 200_000 + "\n" + mit])
    assert {r.license for r in got} == {"MIT"} and sum(r.length for r in got if r.doc_id == 0) == len(mit) * 60
    docs = spark.createDataFrame([(1, mit), (1, mit)], "doc_id long, text string")
    assert scan(docs).count() == 2
    assert scan(docs.limit(0)).count() == 0
    assert difference(words_of("a b c d"), words_of("b c")) == (0, 2)
    assert blocks("", set()) == []


def test_planted_lines_are_found(spark):
    import re

    docs = read(spark, "/root/testdata/sf0.01", "documents")
    lines = {r.doc_id for r in docs.collect() if re.search(r"(?m)^(Licensed under|Released under|This work is licensed)", r.text or "")}
    assert lines <= {r.doc_id for r in scan(docs).collect() if r.confirmed}


MIT_FILE = """MIT License

Copyright (c) 2019 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

BSD_FILE = """BSD 3-Clause License

Copyright (c) 2019, Some Body

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def test_whole_licences_are_confirmed(spark):
    prose = "Erhe ththat nding ertha wasthe.\n"
    for name, text in (("MIT", MIT_FILE), ("BSD-3-Clause", BSD_FILE)):
        first, last = text.index("\n\n", text.index("Copyright")) + 2, text.rstrip()
        for own in (text, " ".join(text[first:].split()), prose + text + prose):
            got = [r for r in one(spark, [own]) if r.confirmed]
            assert [r.license for r in got] == [name], (name, own)
            assert got[0].length >= 0.95 * len(" ".join(last[first:].split()))


def test_a_block_of_any_length_is_one_block(spark):
    """On both sides of the length at which blocks were once cut."""
    import time

    unit = "Permission is granted to use and copy this software and the software is provided as is without warranty of any kind. "
    for times in (150, 200, 20_000):
        docs = spark.createDataFrame([(1, unit * times)], "doc_id long, text string")
        start = time.time()
        got = scan(docs).collect()
        assert [(r.block, r.start, r.length, r.confirmed) for r in got] == [(0, 0, len((unit * times).rstrip()), False)]
        assert time.time() - start < 60
