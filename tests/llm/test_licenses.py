import re

import pytest

from tilewright.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "


def test_whole_licenses_and_one_other_word(spark):
    whole = {"mit": MIT, "bsd-2-clause": BSD.format(""), "bsd-3-clause": BSD.format(NAMES)}
    rows, want = [], {}
    for name, t in whole.items():
        w = t.split()
        rows.append((len(rows), "(c) 2020 " + t + " more")), want.setdefault(len(rows) - 1, name)
        for at in range(0, len(w), 7):
            rows.append((len(rows), " ".join(w[:at] + ["zebra", *w[at:]])))
    rows.append((len(rows), "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: pay us money."))
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: x for i, x in got.items() if i in want} == want
    # a word more is only taken where a replaceable region stands, or before and after the license
    taken = [i for i, x in got.items() if i not in want and x]
    assert len(taken) <= 14 and got[len(rows) - 1] == ""


def test_automata_against_regular_expressions():
    """All matches of small templates, found again by trying every stretch of words with a regular expression."""
    import random

    rng = random.Random(3)
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(2, 6)):
            parts.append(rng.choice(["a", "b", "c", "[[a]]", "[[b c]]", "{{2}}", "[[a {{1}} b]]"]))
        template = " ".join(["a", *parts])
        auto = licenses.compile_template("t", template)
        pattern = ""
        for t in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|\w+", template):
            pattern += "(?:" if t == "[[" else ")?" if t == "]]" else rf"(?:\w+ ){{0,{t[2:-2]}}}" if t[0] == "{" else t + " "
        words = [rng.choice("abcd") for _ in range(12)]
        for p in range(len(words)):
            ends = [e for e in range(p, len(words) + 1) if re.fullmatch(pattern, "".join(w + " " for w in words[p:e]))]
            assert auto.accepts(words, p) == (min(ends) if ends else None), (template, words, p)


def base(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    at = sorted((i, lab) for p, lab in licenses.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))


def test_base_and_templates(spark):
    mit = MIT
    rows = [
        (1, "Licensed under the Apache License, Version 2.0."), (2, "x. Released under the MIT License.\nand MIT licenses, MIT-license"), (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under CC BY-NC 4.0."), (5, mit), (6, mit.replace("merge", "fuse")), (13, "word " * 200_000 + mit), (7, None), (8, ""), (9, "émit license mité license mit  licensé"), (10, "MIT"), (10, "MIT"), (11, "license mit"), (12, "general public license " * 3 + "apache license"),
    ]
    docs = spark.createDataFrame([(i, t, "l") for i, t in rows], "doc_id long, text string, labels string")
    got = licenses.scan_licenses(docs)
    by = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(rows)
    for i, t in rows:
        assert tuple(by[i])[1:6] == base(t), i
        assert set(by[i]["base_labels"].split(",")) - {""} <= set(by[i]["labels"].split(",")) and 0 <= by[i]["score"] <= 1
    assert [by[i]["labels"] for i in (1, 2, 3, 4, 5, 6, 13)] == ["apache,apache-2.0", "mit", "gpl,gpl-3.0", "cc-by-nc-4.0", "mit", "", "mit"]
    assert by[5]["score"] > by[2]["score"] > 0.25 > by[6]["score"] == 0
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_automaton_regions():
    a = licenses.compile_template("t", "one [[two three]] {{2}} four")
    ok = lambda s: a.accepts(s.split(), 0)
    assert (ok("one four"), ok("one two three four"), ok("one x y four z"), ok("one two three x y four")) == (2, 4, 4, 6)
    assert ok("one x y z four") is None and ok("two three four") is None and ok("one") is None
    assert a.mandatory == 2


def test_every_mandatory_word_counts():
    """Each whole license with one other word at every mandatory place, and with every such word left out."""
    whole = [t for t in licenses.TEMPLATES if len(t[1].split()) > 60]
    assert {x for x, _ in whole} == {"mit", "isc", "bsl-1.0", "unlicense", "bsd-2-clause", "bsd-3-clause", "zlib", "apache-2.0"}
    for label, template in whole:
        a = licenses.compile_template(label, template)
        plain = re.sub(r"\[\[.*?\]\]|\{\{\d+\}\}", " ", template).split()
        assert a.accepts(plain, 0) == len(plain), label
        regions = {len(re.sub(r"\[\[.*?\]\]|\{\{\d+\}\}", " ", template[: m.start()]).split()) for m in re.finditer(r"\{\{\d+\}\}", template)}
        for i in range(len(plain)):
            assert a.accepts([*plain[:i], "zebra", *plain[i + 1 :]], 0) is None, (label, i)
            assert i in regions or i == 0 or a.accepts([*plain[:i], "zebra", *plain[i:]], 0) is None, (label, i)
            gone = [*plain[:i], *plain[i + 1 :], "end"]
            assert a.accepts(gone, 0) is None or gone[: len(plain) - 1] == plain[:-1] and i == len(plain) - 1, (label, i)


def test_replaced_regions_and_denials(spark):
    goods = licenses.TEMPLATES[0][1].replace("the software", "the stolen goods").replace("{{8}}", "the authors").replace("[[including the next paragraph]] ", "")
    rows = [
        (1, goods), (2, MIT.replace("the Software", "")), (3, "It is not licensed under the MIT license."), (4, "It is licensed under the MIT license."), (5, "never released under the MIT license"), (6, "This isn't licensed under the Apache License, Version 2.0"),
        (7, "Not for sale. Released under the MIT license"), (8, "No longer licensed under the MIT License"), (9, "my own license: do what you like. Really Do."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [m["label"] for m in r["matches"]] for r in licenses.scan_licenses(docs).collect()}
    assert got == {1: [], 2: [], 3: [], 4: ["mit"], 5: [], 6: [], 7: ["mit"], 8: [], 9: []}
    own = licenses.templates_from({"own": "Do what you like. Really, do!"})
    more = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(docs, templates=licenses.TEMPLATES + own).collect()}
    assert more[9] == "own" and more[4] == "mit"


def test_long_licenses_from_files(spark):
    """Whole long licenses among other text, and each with one word changed at forty places."""
    import os

    folder = "/usr/share/common-licenses"
    names = ["GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "Apache-2.0", "MPL-2.0", "CC0-1.0"]
    if not all(os.path.exists(f"{folder}/{n}") for n in names):
        pytest.skip("no license files here")
    texts = {"whole " + n.lower(): open(f"{folder}/{n}", encoding="utf-8").read() for n in names}
    rows = []
    for n, t in texts.items():
        rows.append((n, f"Copyright someone.\n{t}\nAnd more."))
        w = WORD.findall(licenses.templates_from({n: t})[0][1])
        rows += [("", " ".join([*w[:i], "zebra", *w[i + 1 :]])) for i in range(0, len(w), len(w) // 40)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: {m["label"] for m in r["matches"]} & texts.keys() for r in licenses.scan_licenses(docs, templates=licenses.TEMPLATES + licenses.templates_from(texts)).collect()}
    assert got == {i: {n} - {""} for i, (n, _) in enumerate(rows)}
