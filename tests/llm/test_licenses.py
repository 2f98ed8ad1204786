import re

import edges

from tamarack.llm.licenses import BASE, base_places, detect, matched, normalized, rules, scan_licenses


def found(text):
    words = normalized(text.encode())
    return [(" ".join(w.decode() for w in words[a:b]), label) for a, b, label, _, _ in detect(words)]


def test_rules_are_many_and_ordered():
    table = rules()
    assert len(table) > 200
    assert [r.priority for r in table] == sorted((r.priority for r in table), reverse=True)
    assert len({r.name for r in table}) == len(table)


def test_a_longer_find_suppresses_what_lies_in_it():
    assert found("Licensed under the Apache License, Version 2.0") == [
        ("licensed under the apache license version 2 0", "apache-2.0")
    ]
    assert found("SPDX-License-Identifier: GPL-2.0") == [("spdx license identifier gpl 2 0", "gpl-2.0")]


def test_priority_decides_between_equal_places():
    words = normalized(b"released under the mit license")
    assert [(label, rule) for _, _, label, rule, _ in detect(words)] == [("mit", "grant-mit")]


def test_gates_never_lose_a_find():
    texts = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "distributed under the terms of the GNU General Public License v3",
        "the Boost Software License and the zlib license; all rights reserved",
        "available under cc by nc sa, or the Eclipse Public License 2.0; BSD 3-clause license",
    ]
    for text in texts:
        words = normalized(text.encode())
        body = b" " + b" ".join(words) + b" "
        matched = {r.label for r in rules() if r.pattern.search(body)}
        present = set(words)
        gated = {
            r.label for r in rules() if r.pattern.search(body) and not any(g.isdisjoint(present) for g in r.gates)
        }
        assert matched == gated


def test_base_places_match_brute_force(spark, root):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    extra = [(10**9, "MIT License mit license. General  Public-License"), (10**9 + 1, "mité license"), (10**9 + 2, None)]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for r in docs.collect():
        words = word.findall((r.text or "").translate(lower))
        places = sorted(
            (i, label)
            for phrase, label in BASE
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        )
        g = got[r.doc_id]
        assert (g.n_words, g.n_base) == (len(words), len(places))
        assert (g.first_word, g.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert g.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, g.base_labels.split(","))) <= set(filter(None, g.labels.split(",")))
        assert 0 <= g.score <= 1 and (g.score > 0) == bool(g.labels)


def test_odd_rows(spark):
    got = edges.collected(scan_licenses(edges.frame(spark)))
    assert got == edges.collected(scan_licenses(edges.clashing(spark)))
    assert len(got) == len(edges.rows())
    assert scan_licenses(edges.empty(spark)).count() == 0
    by_id = {r[0]: r for r in got}
    assert by_id[4][1:7] == (0, 0, None, None, "", "")


def test_base_places_touching():
    assert base_places(matched(normalized(b"mit license mit license"))) == [(0, "mit"), (2, "mit")]


def test_base_places_come_from_the_rules_before_suppression():
    finds = matched(normalized(b"licensed under the mit license"))
    assert base_places(finds) == [(3, "mit")]
    assert [label for _, _, label, rule, _ in detect(normalized(b"licensed under the mit license")) if rule.startswith("base-")] == []


def test_versions_in_one_word():
    assert [label for _, label in found("released under GPLv3")] == ["gpl-3.0"]
    assert [label for _, label in found("under the GNU GPLv2 license; AGPLv3 license, LGPLv2.1 license; LGPLv3 licence")] == [
        "gpl-2.0", "agpl-3.0", "lgpl-2.1", "lgpl-3.0",
    ]
