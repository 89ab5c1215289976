"""License scans by matching template markup.

A template is a license's wording with regions: ``[[words]]`` may be left out, ``{{n}}`` stands for up to n other words.
It is compiled into an automaton over words: a state after each mandatory word, steps that skip optional words, and states
that swallow replaceable ones. A text has the license if the automaton, begun at some word, reaches its end, that is, if
all mandatory wording stands there word for word. Automata start only at words that may begin a template, found by
fingerprints of all words of a slice at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tilewright.llm import bytetext as bt

#: Words: runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Phrases and the labels that they give wherever their words stand one after the other.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: The wording of published licenses, and of the notices by which a text is put under one. A label's template is the
#: whole text, so that one other word anywhere in its mandatory wording is another license.
_AS_IS = "this software is provided by {{8}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
_DAMAGES = ("in no event shall {{10}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data "
            "or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of "
            "this software even if advised of the possibility of such damage")
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met [[1]] redistributions of source code must retain the above "
        "copyright notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution")
_BSD_NAMES = "[[3]] neither the name of {{10}} nor the names of [[its]] [[the]] [[their]] contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_GPL = "under the terms of the gnu {}general public license as published by the free software foundation either version {} of the license or at your option any later version"
_GRANT = "licensed under [[the terms of]] [[a]] [[the]]"

#: Labels and templates of licenses and of notices that refer to them.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without "
            "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following "
            "conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is provided as is without "
            "warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {{8}} be liable for any "
            "claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc", "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in "
            "all copies the software is provided as is and {{4}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall {{4}} "
            "be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other "
            "tortious action arising out of or in connection with the use or performance of this software"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display "
                "distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following the "
                "copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or "
                "in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor the software "
                "is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose title and non infringement in no event "
                "shall the copyright holders or anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software "
                "or the use or other dealings in the software"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled "
                  "binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the "
                  "software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of "
                  "relinquishment in perpetuity of all present and future rights to this software under copyright law the software is provided as is without warranty of any kind express or implied including but not "
                  "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors be liable for any claim damages or other liability whether in an action "
                  "of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd-2-clause", f"{_BSD} {_AS_IS} {_DAMAGES}"),
    ("bsd-3-clause", f"{_BSD} {_BSD_NAMES} {_AS_IS} {_DAMAGES}"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to "
             "anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions [[1]] the origin of this software must "
             "not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not "
             "required [[2]] altered source versions must be plainly marked as such and must not be misrepresented as being the original software [[3]] this notice may not be removed or altered from any source distribution"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at [[http]] [[https]] www apache org licenses license 2 0 unless required by "
                   "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the "
                   "license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", f"{_GRANT} apache license [[version]] 2 0"),
    ("mit", "released under the mit license"),
    ("mit", f"{_GRANT} mit license"),
    *((f"{name}gpl-{v}.0", _GPL.format(words, v)) for name, words, versions in (("", "", "23"), ("a", "affero ", "3"), ("l", "lesser ", "3")) for v in versions),
    ("lgpl-2.1", _GPL.format("lesser ", "2 1")),
    *((f"gpl-{v}.0", f"{_GRANT} gnu general public license [[version]] {v} [[0]]") for v in "23"),
    ("lgpl", f"{_GRANT} gnu lesser general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at [[http]] [[https]] [[www]] mozilla org mpl 2 0"),
    *((f"cc-{kind}-4.0", f"{_GRANT} {words} 4 0 [[international]]") for kind, both in (
        ("by", ("cc by", "creative commons attribution")), ("by-sa", ("cc by sa", "creative commons attribution sharealike")), ("by-nc", ("cc by nc", "creative commons attribution noncommercial")),
        ("by-nd", ("cc by nd", "creative commons attribution noderivatives")), ("by-nc-sa", ("cc by nc sa", "creative commons attribution noncommercial sharealike")),
        ("by-nc-nd", ("cc by nc nd", "creative commons attribution noncommercial noderivatives"))) for words in both),
    ("proprietary", "all rights reserved {{8}} without [[the]] [[prior]] written permission"),
)


_LOWER = {c: c + 32 for c in range(65, 91)}

#: Words that deny what follows them; a notice with one of them among the two words before it puts nothing under a license.
DENIALS = {"not", "never", "cannot", "neither", "nor", "no", "isn", "aren", "wasn", "weren", "unless", "isnt", "arent"}
#: Words that notices begin with.
NOTICES = {"licensed", "released", "under"}


#: What ends the wording of long licenses; appendices after it say how to apply them.
ENDS = "end of terms and conditions"


def templates_from(texts: dict[str, str]) -> tuple[tuple[str, str], ...]:
    """Templates of whole license texts by label, for licenses that a user has the files of (GPL, LGPL, AGPL, Apache, MPL, CC0, ...): all
    their words are mandatory, to the end of terms and conditions where a text marks it."""
    words = lambda t: " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(_LOWER)))
    cut = lambda w: w[: w.index(ENDS) + len(ENDS)] if ENDS in w else w
    return tuple((label, cut(words(t))) for label, t in texts.items())


@dataclass
class Automaton:
    """States 0..n; ``word`` leads from a state to the next, ``skip`` from a state past an optional region, ``any`` keeps it."""

    label: str
    words: list[str | None]
    skips: dict[int, list[int]]
    mandatory: int

    def closure(self, states: set[int]) -> set[int]:
        open_ = list(states)
        while open_:
            for t in self.skips.get(open_.pop(), ()):
                if t not in states:
                    states.add(t)
                    open_.append(t)
        return states

    def accepts(self, words: list[str], at: int) -> int | None:
        """The first word after the shortest match that begins at ``at``, else None."""
        states, end = self.closure({0}), len(self.words)
        while True:
            if end in states:
                return at
            if at >= len(words) or not states:
                return None
            states = self.closure({s + 1 for s in states if self.words[s] is None or self.words[s] == words[at]})
            at += 1

    def starts(self) -> set[str]:
        return {self.words[s] for s in self.closure({0})}


def compile_template(label: str, text: str) -> Automaton:
    words: list[str | None] = []
    skips: dict[int, list[int]] = {}
    opened: list[int] = []
    mandatory = 0
    for part in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", text):
        if part == "[[":
            opened.append(len(words))
        elif part == "]]":
            skips.setdefault(opened.pop(), []).append(len(words))
        elif part.startswith("{{"):
            for _ in range(int(part[2:-2])):
                skips.setdefault(len(words), []).append(len(words) + 1)
                words.append(None)
        else:
            words.append(part)
            mandatory += not opened
    return Automaton(label, words, skips, mandatory)


def _hash(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(x) for x in data])
    sums = bt.prefix_sums(np.frombuffer(b"".join(data), np.uint8), bt.byte_table(True))
    return bt.spans_hash(sums, np.r_[0, ends[:-1]], ends)


_RESULT = "doc_id {}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label: string, first: long, end: long>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, base=BASE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches) for each row.

    The base columns say where phrases of ``base`` stand; ``labels`` has those of accepted templates too, and ``matches``
    where. A notice that is denied ("not licensed under ...") is none. ``score`` is 0 without any place, 0.25 for a phrase alone, else m / (m + 2) of the longest accepted template's m
    mandatory words. A null or empty text has no words; repeated rows stay; texts may be of any length; an empty table gives an
    empty result. Other columns are not looked at. Where several templates begin at a word, each counts.
    """
    automata = [compile_template(*t) for t in templates]
    phrases = [(_hash(p.split()), label) for p, label in base]
    first_words = sorted({w for a in automata for w in a.starts()})
    heads = np.sort(_hash(first_words))
    by_head: dict[str, list[Automaton]] = {w: [a for a in automata if w in a.starts()] for w in first_words}
    second = np.sort(_hash(sorted({a.words[s + 1] for a in automata for s in a.closure({0}) if s + 1 < len(a.words) and a.words[s + 1]} | {a.words[t] for a in automata for s in a.closure({0}) for t in a.closure({s + 1}) if t < len(a.words) and a.words[t]})))

    def among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, h)
        at[at == len(known)] = 0
        return known[at] == h

    def scan(d: np.ndarray, off: np.ndarray) -> list[tuple]:
        n = len(off) - 1
        start, end, text = bt.words(d, off, WORD)
        h = bt.spans_hash(bt.prefix_sums(d, bt.byte_table(True)), start, end)
        first = np.searchsorted(text, np.arange(n + 1))
        places: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        for p, label in phrases:
            m = len(h) - len(p) + 1
            if m > 0:
                hit = text[:m] == text[len(p) - 1 :]
                for j, x in enumerate(p):
                    hit &= h[j : m + j] == x
                for i in np.flatnonzero(hit):
                    places[text[i]].append((int(i - first[text[i]]), label))
        found: list[list[tuple[str, int, int, int]]] = [[] for _ in range(n)]
        begin = np.flatnonzero(among(h, heads))
        begin = begin[begin + 1 < len(h)]
        begin = begin[among(h[begin + 1], second) & (text[begin + 1] == text[begin])]
        for i in np.unique(text[begin]):
            words = [d[s:e].tobytes().decode(errors="replace") for s, e in zip(start[first[i] : first[i + 1]], end[first[i] : first[i + 1]], strict=True)]
            words = [w.translate(_LOWER) for w in words]
            for p in begin[text[begin] == i] - first[i]:
                for a in by_head.get(words[p], ()):
                    denied = words[p] in NOTICES and not DENIALS.isdisjoint(words[max(0, p - 2) : p])
                    stop = None if denied else a.accepts(words, int(p))
                    if stop is not None:
                        found[i].append((a.label, int(p), stop, a.mandatory))
        rows = []
        for i in range(n):
            at = sorted(p for p, _ in places[i])
            labels = {x for _, x in places[i]}
            most = max((m for *_, m in found[i]), default=0)
            score = most / (most + 2) if most else 0.25 if at else 0.0
            rows.append((int(first[i + 1] - first[i]), len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted(labels)), ",".join(sorted(labels | {x[0] for x in found[i]})), score,
                         [{"label": x, "first": p, "end": e} for x, p, e, _ in sorted(found[i], key=lambda y: (y[1], y[0], y[2]))]))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())])))
        for batch in batches:
            data, off = bt.column_bytes(batch.column(1))
            for i, j, d, o in bt.slices(data, off):
                cols = zip(*scan(d, o), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array(x, t) for x, t in zip(cols, kinds, strict=True))],
                                                 ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, _RESULT.format(rows.schema["doc_id"].dataType.simpleString()))
