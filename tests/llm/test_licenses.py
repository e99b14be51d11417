import random
import re

import pytest
from pyspark.sql import functions as F

from terrace.llm import licenses
from terrace.llm.licenses import BASE, Automaton


def accepts(template, text):
    return Automaton(template).accepts([w.encode() for w in text.split()], 0)


def test_optional_replaceable_and_alternative_regions():
    t = "under [[the]] {mit|bsd} license <<1-2>> end"
    assert accepts(t, "under the mit license x end") == 6
    assert accepts(t, "under bsd license x y end more") == 6
    assert not accepts(t, "under the license x end")          # mandatory wording missing
    assert not accepts(t, "under mit license end")            # too few words in the replaceable region
    assert not accepts(t, "under mit license x y z end")      # too many
    assert not accepts(t, "under the the mit license x end")


def test_automaton_against_a_regular_expression():
    rng = random.Random(2)
    t, pattern = "a [[b <<0-2>> c]] {a|d} [[b]] c", r"a (b (\w )?(\w )?c )?(a|d) (b )?c"
    for _ in range(5000):
        text = " ".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
        # the automaton stops at the shortest accepted run; the expression tells whether there is one
        ends = [i for i in range(1, len(text.split()) + 1) if re.fullmatch(pattern, " ".join(text.split()[:i]))]
        assert accepts(t, text) == (ends[0] if ends else 0), text


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT License.", {"mit"}),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", {"apache"}),
    ("This work is licensed under CC BY 4.0", {"cc-by"}),
    ("redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", {"gpl"}),
    ("SPDX-License-Identifier: GPL-3.0-only", {"gpl"}),
    ("the license plate of a gnu", set()),
])
def test_wording(text, labels):
    words = licenses._WORD.findall(text.encode().lower())
    assert licenses.scan(words)[4] == labels


def test_base_places_match_brute_force(make_docs):
    rng = random.Random(4)
    parts = ["gnu", "general", "public", "license", "apache", "cc", "by", "MIT", "x", "é", "cc-by"]
    rows = [(i, rng.choice([" ", ", "]).join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(150)]
    got = {r["doc_id"]: r for r in licenses.find_licenses(make_docs(rows)).collect()}
    for i, text in rows:
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if x]
        places = [(j, label) for p, label in BASE.items() for j in range(len(w)) if w[j:j + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not places
        assert (r["score"] > 0) == bool(r["labels"]) and 0 <= r["score"] <= 1


def test_frame(odd_docs, no_docs, make_docs):
    got = licenses.find_licenses(odd_docs).collect()
    assert len(got) == 8 and all(r["labels"] == "" and r["score"] == 0 and r["first_word"] is None for r in got)
    assert licenses.find_licenses(no_docs).count() == 0
    d = make_docs([(1, "mit license")]).withColumn("labels", F.lit("mine")).withColumn("s", F.lit(0))
    assert licenses.find_licenses(d).first()["labels"] == "mit"


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
EXTRA
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
 * 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
 * 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
 *    in the documentation and/or other materials provided with the distribution.
EXTRA
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. EXTRA THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN
NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. EXTRA In jurisdictions that recognize copyright laws, the author or authors of this software dedicate
any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large
and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law. """ + MIT[MIT.index("THE SOFTWARE IS"):]
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. EXTRA You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. EXTRA This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. EXTRA If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
CLAUSE = "The Software shall be used for Good, not Evil, and never in any commercial product."


def test_only_whole_licenses_are_grants(make_docs):
    whole = {"mit": [MIT, MIT.replace('"Software"', "“Software”").replace('"AS IS"', "“AS IS”"), MIT.replace("NONINF", "NON-INF")],
             "bsd": [BSD, BSD.replace("EXTRA", THIRD)], "isc": [ISC, ISC.replace("and/or", "and")], "unlicense": [UNLICENSE],
             "apache": [APACHE], "gpl": [GPL, GPL.replace("GNU General", "GNU Lesser General")], "mpl": [MPL]}
    texts = [(label, t) for label, ts in whole.items() for t in ts]
    rows = []
    for _, t in texts:
        words = t.replace("EXTRA", "").split()
        rows += ["Copyright (c) 2020 X\n" + t.replace("EXTRA", "") + " more", t.replace("EXTRA", CLAUSE) if "EXTRA" in t else t + CLAUSE,
                 " ".join(words[:-8]), " ".join(words).replace("any", "no").replace("ANY", "NO").replace("was not", "was")]
    got = {r["doc_id"]: r for r in licenses.find_licenses(make_docs(list(enumerate(rows)))).collect()}
    for k, (label, t) in enumerate(texts):
        assert label in got[4 * k]["labels"].split(",") and got[4 * k]["score"] == 1.0, t
        for j in (1, 2, 3):
            if "EXTRA" in t or j > 1:
                assert got[4 * k + j]["score"] <= 0.75, rows[4 * k + j]
