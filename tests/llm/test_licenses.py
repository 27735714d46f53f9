import re

import pytest
from loomgraph.llm import licenses

TEXTS = [
    "This is released Under the MIT License, cc by-nc 4.0. CC-BY-NC!",
    "Licensed under the Apache License, Version 2.0. Some É words, naïve ones",
    "under the mit license under the mit license",
    "cc by nc cc by nc cc by nc",
    "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: BSD-3-Clause and also permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "underthe mit license under the\nmit--license Kelvin K k",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Neither the name of the Foo Bar Project nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "http://creativecommons.org/licenses/by-nc-sa/4.0/ and https://www.gnu.org/licenses/gpl-3.0.html, see opensource.org/licenses/MIT", "x " * 100_000 + "under the MIT license" + " y" * 100_000,
    "", "   ", None, "just words in the wood, under a tree", "licensed under CC BY-NC-SA 4.0",
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    found, ws = [], words(text)
    joined = " " + " ".join(ws) + " "
    for label, priority, confidence, _, pattern, base in licenses.rules():
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", joined):
            first = joined[: m.start()].count(" ") - 1
            found.append((label, priority, confidence, base, first, first + m[0].count(" "), pattern))
    kept = []
    for d in found:
        rank = lambda x: (x[4], -x[5], x[1], x[0], x[6])
        inside = any(e is not d and e[4] <= d[4] and e[5] >= d[5] and e[1] <= d[1] and rank(e) < rank(d) for e in found)
        if d[3] or not inside:
            kept.append(d)
    base = [d for d in found if d[3]]
    return (
        len(ws), len(base), min((d[4] for d in base), default=None), max((d[4] for d in base), default=None),
        ",".join(sorted({d[0] for d in base})), ",".join(sorted({d[0] for d in kept})), max((d[2] for d in kept), default=0.0),
    )


def test_scan_equals_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as row", "'x' as words", "2 as label")
    got = sorted((tuple(r) for r in licenses.scan(docs).collect()), key=str)
    assert got == sorted(((k, *brute(t)) for k, t in rows), key=str)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_base_places(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    by = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (by[2].n_base, by[2].first_word, by[2].last_word) == (2, 0, 4)
    assert by[3].n_base == 3 and by[0].base_labels == "cc-by-nc,mit" and by[1].base_labels == "apache-2"
    assert by[4].labels == "gpl-3" and by[13].labels == "" and by[13].score == 0 and by[9].first_word == 100_000 and by[9].n_words == 200_004
    assert by[14].labels == "cc-by-nc,cc-by-nc-sa" and by[14].base_labels == "cc-by-nc" and by[7].labels == "bsd,bsd-3-clause" and by[8].labels == "cc-by-nc-sa,gpl-3,mit"


def test_gates_hold_for_every_rule():
    """Of every rule that is plain text: it passes the gate, and its anchor and one of its keywords stand in it."""
    for label, _, _, (anchor, keywords), pattern, _ in licenses.rules():
        if not set(pattern) & set("()[]{}?*+|\\"):
            text = f" {pattern} "
            assert anchor in text and any(k in text for k in keywords.split("|")) and any(g in text for g in licenses.GATE), (label, pattern)


def test_hundreds_of_rules():
    assert len(licenses.rules()) > 300 and len({r[4] for r in licenses.rules()}) == pytest.approx(len(licenses.rules()), abs=40)
