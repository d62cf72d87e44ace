"""License scan against trying every rule on every text and comparing all intervals."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from moodwire.llm import license_rules, license_scan, queries

RULES = license_rules.rules()


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base_by_hand(text):
    words = words_of(text)
    places = [(i, label) for phrase, label in license_rules.BASE_PHRASES.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    first = [i for i, _ in places]
    return len(words), len(places), min(first, default=None), max(first, default=None), ",".join(sorted({x for _, x in places}))


def found_by_hand(text):
    """(first word, words, label, priority) that no other rule's interval of higher rank holds, all rules tried."""
    line = f" {' '.join(words_of(text))} "
    spans = [(line[:m.start()].count(" ") - 1, line[:m.end()].count(" "), k) for k, r in enumerate(RULES)
             for m in re.finditer(rf"(?<= )(?:{r.pattern})(?= )", line)]
    rank = lambda s: (RULES[s[2]].priority, s[1] - s[0], -s[2], -s[0])
    kept = [s for s in spans if not any(o[0] <= s[0] and s[1] <= o[1] and rank(o) > rank(s) for o in spans if o != s)]
    return sorted((a, b - a, RULES[k].label, RULES[k].priority) for a, b, k in kept)


TEXTS = [
    None, "", " \n ", "x", "MIT License", "the mit-license, and: CC BY 4.0!", "Committed limits permit licenses",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "SPDX-License-Identifier: GPL-2.0-only\nGNU General Public License version 2 or later",
    "GNU Lesser General Public License v2.1 and the GNU General Public License v3.0", "cc by cc by cc by-sa 3.0 cc by",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/ Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "released into the public domain. All rights reserved.", "é mit license é", "mit\tLICENSE mitlicense mit_license mit.license",
]


def test_rules_are_hundreds_and_compile():
    assert len(RULES) > 300 and all(license_rules.compiled(r) for r in RULES)
    assert [r.label for r in RULES if r.base] == list(license_rules.BASE_PHRASES.values())


@pytest.mark.parametrize("rule", random.Random(1).sample(RULES, 60) + [r for r in RULES if r.priority in (license_rules.TEXT, license_rules.HINT)],
                         ids=lambda r: f"{r.label}-{r.priority}")
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_every_match_holds_its_keyword(rule, data):
    match = data.draw(st.from_regex(rule.pattern, fullmatch=True, alphabet=st.characters(codec="ascii")))
    assert rule.keyword in f" {match} "


def test_suppression_against_all_pairs():
    rnd = random.Random(5)
    for _ in range(300):
        found = list({(a := rnd.randrange(20), a + rnd.randrange(1, 9), rnd.randrange(6), rnd.choice([20, 50, 90])) for _ in range(25)})
        rank = lambda f: (f[3], f[1] - f[0], -f[2], -f[0])
        want = [f for f in found if not any(o != f and o[0] <= f[0] and f[1] <= o[1] and rank(o) > rank(f) for o in found)]
        assert license_scan.suppressed(found) == sorted(want)


def test_scan_by_hand(frame):
    rnd = random.Random(2)
    pieces = [t for t in TEXTS if t]
    texts = TEXTS + [" ".join(rnd.choices(pieces + ["and", "so on", "the license"], k=rnd.randint(1, 12))) for _ in range(60)] + ["mit license " * 20000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "mit license"), (3, "x"), (3, "x")]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(rows)).collect()}
    for i, t in enumerate(texts[:-1]):
        if i != 3:
            assert [tuple(f) for f in got[i].found] == found_by_hand(t)
            assert (got[i].n_words, len(got[i].base)) == base_by_hand(t)[:2]
    digest = license_scan.license_digest(frame(rows)).collect()
    assert len(digest) == len(rows)
    for r in digest:
        t = "mit license" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert license_scan.license_digest(frame(rows).limit(0)).collect() == []


def test_labels_of_usual_forms(frame):
    forms = {"cc-by-4.0": "This work is licensed under CC BY 4.0.", "apache-2.0": "Licensed under the Apache License, Version 2.0",
             "gpl-2.0": "// SPDX-License-Identifier: GPL-2.0-or-later", "mit": "the MIT License (MIT)", "lgpl-2.1": "GNU Lesser General Public License v2.1",
             "bsd-3-clause": "BSD 3-Clause License", "cc-by-nc-sa-4.0": "https://creativecommons.org/licenses/by-nc-sa/4.0/"}
    rows = list(enumerate(forms.values()))
    got = {r.doc_id: r for r in license_scan.license_digest(frame(rows)).collect()}
    for i, label in enumerate(forms):
        assert label in got[i].labels.split(",")


def test_license_query(spark, small_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = queries.QUERIES["op12_license_scan"](spark, small_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(docs[r.doc_id])
