"""License scans by template-markup matching.

A template is license wording with markup: ``[[ ... ]]`` encloses words that may be
missing, ``<<a-b>>`` stands for a to b words of any kind, and ``{x|y}`` for one of several
words.  A template compiles into an automaton over words; a text is accepted where all
mandatory words stand in order with only the marked variation between them.
A place is tried only where the template's first word stands, and only one state set
is kept, so a text costs time in proportion to its words.

The four base phrases are templates without markup.  The score is 0 without a match, 0.5
for a base phrase alone (a mention), and 1 only where a whole license is accepted from its first
mandatory word to its last (a grant).  Openings of licenses and statements that name one
are partial: they rise from 0.5 to 0.75 with the number of words accepted, and so do licenses that
were cut off or altered behind their opening.

Whole are the bodies of mit, bsd (2 to 4 clauses), isc and unlicense, and the notices that apache, gpl and
mpl prescribe for files.  The long bodies of apache, gpl, mpl and cc-by have no template.  Words
behind the end of a license are not compared.

Defined cases: null or empty text has no words, no labels and score 0; equal rows give equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from terrace.llm.common import struct_type

#: Base phrases and their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Openings and statements with markup, and the label they point to.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<1-12>> "
            "to deal in the {software|work} without restriction"),
    ("mit", "{licensed|released|distributed|available} under [[the]] [[terms of the]] mit {license|licence}"),
    ("mit", "spdx license identifier mit"),
    ("apache", "licensed under the apache {license|licence} [[version]] <<0-3>> [[the license]] "
               "you may not use this file except in compliance with the license"),
    ("apache", "{licensed|released|distributed|available} under [[the]] [[terms of the]] apache {license|licence}"),
    ("apache", "spdx license identifier apache 2 0"),
    ("gpl", "{redistribute|modify} it [[and or modify it]] under the terms of the gnu [[lesser]] [[affero]] "
            "general public {license|licence} as published by the free software foundation"),
    ("gpl", "{licensed|released|distributed|available} under [[the]] [[terms of]] [[the]] gnu [[lesser]] [[affero]] "
            "general public {license|licence} [[v]] <<0-1>>"),
    ("gpl", "spdx license identifier {gpl|lgpl|agpl} <<1-2>>"),
    ("cc-by", "creative commons attribution [[<<0-2>> international]]"),
    ("cc-by", "{licensed|released|distributed|available} under [[a]] [[the]] [[creative commons]] cc by"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "{licensed|released|distributed|available} under [[the]] [[<<0-1>> clause]] bsd {license|licence}"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("mpl", "subject to the terms of the mozilla public {license|licence}"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
_SOFTWARE, _LICENSE, _AS_IS = "{software|“software”}", "{license|“license”}", "{as|“as|‘as} {is|is”|is’}"
_MIT_WARRANTY = (f"the software is provided {_AS_IS} without warranty of any kind express or implied including but not limited to the "
                 "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<1-12>> be liable "
                 "for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
                 "connection with the software or the use or other dealings in the software")
_GNU = "gnu [[{lesser|library|affero}]] general public license"
#: Whole licenses, or the notices that stand for them, with markup, and the label they prove.
WHOLE = [
    ("mit", f"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
            f"files the {_SOFTWARE} to deal in the software without restriction including without limitation the rights to use copy modify "
            "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
            "furnished to do so subject to the following conditions the above copyright notice and this permission notice "
            "[[including the next paragraph]] shall be included in all copies or substantial portions of the software " + _MIT_WARRANTY),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met [[{1|a|i}]] redistributions of source code must retain the above copyright notice this list of conditions "
            "and the following disclaimer [[{2|b|ii}]] redistributions in binary form must reproduce the above copyright notice this list "
            "of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
            "[[ [[{3|c|iii}]] all advertising materials mentioning features or use of this software must display the following "
            "acknowledgement this product includes software developed by <<1-20>> ]] "
            "[[ [[{3|4|c|d|iii|iv}]] neither the {name|names} of <<1-20>> may be used to endorse or promote products derived from this "
            "software without specific prior written permission ]] "
            f"this software is provided by <<1-12>> {_AS_IS} and any express or implied warranties including but not limited to the implied "
            "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<1-12>> be liable for any "
            "direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute "
            "goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether "
            "in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software "
            "even if advised of the possibility of such damage"),
    ("isc", "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies the software is provided "
            f"{_AS_IS} and <<1-12>> {{disclaims|disclaim}} all warranties with regard to this software including all implied warranties of "
            "merchantability and fitness in no event shall <<1-12>> be liable for any special direct indirect or consequential damages or "
            "any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other "
            "tortious action arising out of or in connection with the use or performance of this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile "
                  "sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non "
                  "commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate "
                  "any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public "
                  "at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment "
                  "in perpetuity of all present and future rights to this software under copyright law " + _MIT_WARRANTY),
    ("apache", f"licensed under the apache license version 2 0 the {_LICENSE} you may not use this {{file|work|software}} except in "
               "compliance with the license you may obtain a copy of the license at [[{http|https}]] [[www]] apache org licenses license 2 0 "
               "[[{html|txt}]] unless required by applicable law or agreed to in writing software distributed under the license is "
               f"distributed on an {_AS_IS} basis without warranties or conditions of any kind either express or implied see the license "
               "for the specific language governing permissions and limitations under the license"),
    ("gpl", f"redistribute it and or modify it under the terms of the {_GNU} as published by the free software "
            "foundation either version <<1-2>> of the license or at your option any later version <<1-4>> is distributed in the hope that it "
            "will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose "
            f"see the {_GNU} for more details you should have received a copy of the {_GNU} along with <<1-4>> if not "
            "{see|write} [[to]] <<1-5>>"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
            "this file you can obtain one at [[{http|https}]] mozilla org mpl 2 0"),
]
#: The same with the last word of the warranty in two.
WHOLE += [(label, t.replace(" noninfringement ", " non infringement ")) for label, t in WHOLE if " noninfringement " in t]
#: Words of accepted wording that give the highest partial score, and what they add to a mention.
ENOUGH, PARTIAL = 12, 0.25

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_ITEM = re.compile(r"\[\[|\]\]|<<\d+-\d+>>|\{[^}]*\}|[0-9a-z]+")


class Automaton:
    """Words to states: ``step[s]`` maps a word (None: any word) to a next state; ``free[s]`` lists
    the states reached without a word."""

    def __init__(self, template: str):
        self.step: list[dict] = [{}]
        self.free: list[list[int]] = [[]]
        opened, here = [], 0
        for item in _ITEM.findall(template):
            if item == "[[":
                opened.append(here)
            elif item == "]]":
                self.free[opened.pop()].append(here)
            elif item[0] == "<":
                low, high = map(int, item[2:-2].split("-"))
                skips = []
                for i in range(high):
                    if i >= low:
                        skips.append(here)
                    here = self._add(here, [None])
                for s in skips:
                    self.free[s].append(here)
            else:
                here = self._add(here, [w.encode() for w in item.strip("{}").split("|")])
        self.final = here
        self.first = frozenset(w for s in self._closed({0}) for w in self.step[s] if w is not None)

    def _add(self, here: int, words: list) -> int:
        self.step.append({})
        self.free.append([])
        for w in words:
            self.step[here][w] = len(self.step) - 1
        return len(self.step) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return out

    def accepts(self, words: list[bytes], at: int) -> int:
        """End of the shortest accepted run of words from ``at``; 0 if there is none."""
        states = self._closed({0})
        for i in range(at, len(words)):
            states = self._closed({t for s in states for k in (words[i], None) if (t := self.step[s].get(k)) is not None})
            if not states:
                return 0
            if self.final in states:
                return i + 1
        return 0


BASE_RUNS = [(label, [w.encode() for w in phrase.split()]) for phrase, label in BASE.items()]
_BASE_AUTOMATA = [(label, Automaton(phrase)) for phrase, label in BASE.items()]
_AUTOMATA = [(label, Automaton(t)) for label, t in TEMPLATES]
_WHOLE_AUTOMATA = [(label, Automaton(t)) for label, t in WHOLE]
_START_OF: dict[bytes, list] = {}
for _kind, _list in (("base", _BASE_AUTOMATA), ("template", _AUTOMATA), ("whole", _WHOLE_AUTOMATA)):
    for _label, _a in _list:
        for _w in _a.first:
            _START_OF.setdefault(_w, []).append((_kind, _label, _a))
_STARTS = frozenset(_START_OF)


def scan(words: list[bytes]) -> tuple:
    """(n_base, first, last, base labels, all labels, words of accepted partial wording, whether a license is whole)."""
    places, base, labels, wording, whole = [], set(), set(), 0, False
    for at, w in enumerate(words):
        for kind, label, automaton in _START_OF.get(w, ()):
            end = automaton.accepts(words, at)
            if not end:
                continue
            labels.add(label)
            if kind == "base":
                places.append(at)
                base.add(label)
            elif kind == "whole":
                whole = True
            else:
                wording = max(wording, end - at)
    return len(places), min(places, default=None), max(places, default=None), base, labels, wording, whole


@pandas_udf(struct_type(n_words="long", n_base="long", first_word="long", last_word="long", base_labels="string",
                        labels="string", score="double"))
def scan_udf(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        words = _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
        if _STARTS.isdisjoint(words):
            rows.append((len(words), 0, None, None, "", "", 0.0))
            continue
        n, first, last, base, labels, wording, whole = scan(words)
        score = 0.0 if not labels else 1.0 if whole else 0.5 + PARTIAL * min(1.0, wording / ENOUGH)
        rows.append((len(words), n, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score))
    out = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return out.astype({"first_word": "Int64", "last_word": "Int64"})


def find_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return docs.select("doc_id", scan_udf(F.col("text")).alias("s")).select("doc_id", "s.*")
