"""License scans against a loop over words and rules."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from llm.fixtures import docs
from tablepull.llm import licenses
from tablepull.llm.license_rules import MAX_WORDS, RULES, STEMS, Rule

PHRASES = [("under the mit license", "mit"), ("cc by nc", "cc-by-nc"), ("a b a", "aba"), ("a b", "ab")]


def brute(text, phrases=PHRASES, rules=RULES):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    norm, hits = " ".join(words) + " ", []
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    for place, rule in enumerate(rules):
        pattern = re.compile(f"({rule.pattern}) ")
        if rule.keyword in norm:
            hits += [(rule.priority, len(m[1].split()), -place, i, rule) for i, start in enumerate(starts) if (m := pattern.match(norm, start))]
    kept = []
    for p, n, o, i, rule in hits:
        nested = [x for x in hits if (x[3] <= i and i + n <= x[3] + x[1]) or (i <= x[3] and x[3] + x[1] <= i + n)]
        if all(x[:3] <= (p, n, o) for x in nested):
            kept.append((rule.label, -o, i, n, rule.weight))
    base = sorted({label for _, label in places})
    labels = sorted(set(base) | {k[0] for k in kept})
    score = max([licenses.PHRASE_WEIGHT] * bool(base) + [k[4] for k in kept], default=0.0)
    first, last = (f((i for i, _ in places), default=None) for f in (min, max))
    return (len(words), len(places), first, last, ",".join(base), ",".join(labels), score), sorted(k[:4] for k in kept)


TEXTS = [
    None, "", " \n\t", "a b a b a", "A-B,a.b", "Released under the MIT License. See CC BY-NC, and cc by nc 4.0 international!",
    "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0 (the License); All rights reserved.",
    "This program is licensed under the terms of the GNU Lesser General Public License version 2.1, or the GNU General Public License, version 3.",
    "the gnu affero general public license v3 and proprietary and confidential; copyright (c) 2020", "Ünder the mit license", "under the mit licenseé under the mit license",
    "\U0001f600 under the mit license", "creative commons attribution non commercial share alike 4.0 international license. public domain work",
    "cc by nc cc by nc cc by nc sa 4 0", "license " * 3000, "x y " * 700 + "under the mit license " + "z " * 900 + "BSD 3-Clause License", "bsd " * 2100 + "under the mit license",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published; either version 2 of the License, or (at your option) any later version",
    "($1 \\ under the mit license \x01\x02 $ cc0 1.0 universal",
]


@pytest.mark.parametrize("chunk_words", [licenses.CHUNK_WORDS, 7])
def test_equals_a_loop(spark, chunk_words):
    table = docs(spark, [*TEXTS, (3, "a b"), (None, "a b a")], extra=True).selectExpr("*", "'x' AS labels", "1 AS n_words")
    got = licenses.scan_licenses(table, PHRASES, chunk_words=chunk_words)
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert [c for c in got.columns if c not in table.columns] == ["n_base", "first_word", "last_word", "base_labels", "detections"]
    rows = got.collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        facts, kept = brute(row["text"])
        assert tuple(row[n] for n in names) == facts
        assert sorted((d["label"], d["place"], d["start"], d["words"]) for d in row["detections"]) == kept
    assert licenses.scan_licenses(table.limit(0), PHRASES).count() == 0


def test_priority_and_containment(spark):
    rules = [Rule("low", "licen", "a license of this kind", 0, 0.1), Rule("high", "licen", "license", 2, 0.9), Rule("long", "licen", "license of", 2, 0.8), Rule("side", "licen", "license of this kind indeed", 0, 0.2), Rule("same", "licen", "license of", 2, 0.8)]
    texts = ["a license of this kind indeed", "a license", "of this kind"]
    for row in licenses.scan_licenses(docs(spark, texts), [], rules).collect():
        assert (row["labels"], row["score"]) == (brute(row["text"], [], rules)[0][5:])
    assert [r["labels"] for r in licenses.scan_licenses(docs(spark, texts), [], rules).orderBy("doc_id").collect()] == ["long", "high", ""]


def test_no_shuffle_and_no_python(spark):
    plan = licenses.scan_licenses(docs(spark, TEXTS), PHRASES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


def test_hundreds_of_rules_with_keywords():
    assert len(RULES) > 200 and len({r.pattern for r in RULES}) == len(RULES)
    assert all(any(s in r.keyword for s in STEMS) or r.keyword for r in RULES)


@pytest.mark.parametrize("part", range(6))
def test_every_match_holds_its_keyword_and_a_stem(part):
    for rule in RULES[part::6]:

        @settings(max_examples=12, deadline=None, database=None, suppress_health_check=list(HealthCheck))
        @given(st.from_regex(re.compile(rule.pattern), fullmatch=True))
        def check(match):
            assert rule.keyword in match, (rule, match)
            assert any(stem in match for stem in STEMS), (rule, match)
            assert len(match.split()) <= MAX_WORDS and "  " not in match and match == match.strip()

        check()
