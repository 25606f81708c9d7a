import random
import re

from propgraph.llm.license_rules import CONFIDENCE, rules
from propgraph.llm.license_scan import BASE, KEYWORDS, detections, license_scan

SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    """The contract's columns, with labels by comparing all pairs of matches."""
    words = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    norm = " ".join(words)
    base = [(k, label) for label, phrase in BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    found = {(m.start(), m.end(), r.priority, r.label) for r in rules() if r.gate in norm for m in re.finditer(r.pattern, norm)}
    kept = [
        x for x in found
        if not any(y != x and y[0] <= x[0] and x[1] <= y[1] and y[2] <= x[2] and ((y[0], y[1]) != (x[0], x[1]) or y[2:] < x[2:]) for y in found)]
    score = max([CONFIDENCE[x[2]] for x in kept] + [CONFIDENCE[-1] if base else 0.0])
    labels = sorted({x[3] for x in kept} | {b for _, b in base})
    return (len(words), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None),
            ",".join(sorted({b for _, b in base})), ",".join(labels), score)


PARTS = ["Licensed under the Apache License, Version 2.0.", "GNU General Public License", "version 3", "CC BY", "-NC 4.0", "MIT license", "the", "mit", "SPDX-License-Identifier: MIT",
         "SPDX-License-Identifier: GPL-3.0-or-later", "All rights reserved", "BSD 3-Clause License", "word", "Über", "license", "Released under MIT", "gpl v2", "\n", "©", "cc0", "cc by cc by",
         "Creative Commons Attribution-ShareAlike 4.0", "Mozilla Public License 2.0", "apache license apache license"]


def test_against_brute_force(rows):
    r = random.Random(9)
    docs = [(k, " ".join(r.choices(PARTS, k=r.randint(0, 12)))) for k in range(300)]
    docs += [(300, None), (301, ""), (302, "."), (303, "İ MIT LICENSE ı"), (304, "the word " * 30_000 + "Licensed under the MIT License " * 400)]
    out = {x.doc_id: tuple(x)[1:] for x in license_scan(rows(docs, SCHEMA)).collect()}
    assert out == {k: brute(t) for k, t in docs}


def test_there_are_hundreds_of_rules_and_each_gate_is_a_keyword():
    assert len(rules()) >= 300
    assert all(any(k in r.gate or k == r.gate for k in KEYWORDS) for r in rules())


def test_longer_and_more_important_matches_win(rows):
    got = {x.label for x in detections(rows([(1, "SPDX-License-Identifier: Apache-2.0. Also: apache license")], SCHEMA)).collect()}
    assert got == {"apache-2.0", "apache", None}


def test_repeated_rows_null_ids_other_columns(rows):
    docs = rows([(None, "MIT License", 1), (1, "MIT License", 2), (1, "MIT License", 2), (1, "gnu general public license", 2)], "doc_id long, text string, label int")
    out = sorted((x.doc_id or 0, x.labels) for x in license_scan(docs).collect())
    assert out == [(0, "mit"), (1, "gpl"), (1, "mit"), (1, "mit")]
    assert license_scan(rows([], SCHEMA)).count() == 0
