"""License detection by ordered signature rules.

Every rule is a regular expression over the normalized words of a text, joined
by single blanks. A rule is tried only if all its keywords are words of the
text. Overlapping finds are resolved by priority: rules are taken from the
highest priority down, and a find that lies inside a find already taken is
suppressed.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tamarack.llm.words import utf8

# Fixed value: what a word is, after A-Z have been lower-cased.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases that are always reported, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, what names the license, and words of which every such name holds one
# (none given: the first word of each name).
FAMILIES = (
    ("mit", "mit|expat|x11", ""),
    ("apache", "apache(?: software)?", "apache"),
    ("apache-2.0", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache"),
    ("apache-1.1", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache"),
    ("gpl", "gnu general public|gnu gpl|gpl", ""),
    ("gpl-2.0", "(?:gnu )?(?:general public license|gpl)(?: version)? v?2(?: 0)?|(?:gnu )?gplv?2(?: 0)?", "general|gpl|gplv2|gpl2"),
    ("gpl-3.0", "(?:gnu )?(?:general public license|gpl)(?: version)? v?3(?: 0)?|(?:gnu )?gplv?3(?: 0)?", "general|gpl|gplv3|gpl3"),
    ("lgpl", "gnu (?:lesser|library) general public|gnu lgpl|lgpl", ""),
    ("lgpl-2.0", "(?:gnu )?(?:library general public license|lgpl)(?: version)? v?2(?: 0)?|(?:gnu )?lgplv?2(?: 0)?", "library|lgpl|lgplv2|lgpl2"),
    ("lgpl-2.1", "(?:gnu )?(?:lesser general public license|lgpl)(?: version)? v?2 1|(?:gnu )?lgplv?2 1", "lesser|lgpl|lgplv2|lgpl2"),
    ("lgpl-3.0", "(?:gnu )?(?:lesser general public license|lgpl)(?: version)? v?3(?: 0)?|(?:gnu )?lgplv?3(?: 0)?", "lesser|lgpl|lgplv3|lgpl3"),
    ("agpl", "gnu affero general public|gnu agpl|agpl|affero", ""),
    ("agpl-3.0", "(?:gnu )?(?:affero general public license|agpl)(?: version)? v?3(?: 0)?|(?:gnu )?agplv?3(?: 0)?", "affero|agpl|agplv3|agpl3"),
    ("bsd", "bsd(?: style)?|berkeley software distribution", "bsd|berkeley"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd|freebsd"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", "bsd"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    ("0bsd", "0bsd|zero clause bsd|bsd zero clause", ""),
    ("isc", "isc|internet systems consortium", ""),
    ("mpl", "mozilla public|mpl", ""),
    ("mpl-1.1", "(?:mozilla public license|mpl)(?: version)? 1 1", "mozilla|mpl"),
    ("mpl-2.0", "(?:mozilla public license|mpl)(?: version)? 2(?: 0)?", "mozilla|mpl"),
    ("epl", "eclipse public|epl", ""),
    ("epl-1.0", "(?:eclipse public license|epl)(?: version)? v?1(?: 0)?", "eclipse|epl"),
    ("epl-2.0", "(?:eclipse public license|epl)(?: version)? v?2(?: 0)?", "eclipse|epl"),
    ("cddl", "common development and distribution|cddl", ""),
    ("cpl", "common public", "common"),
    ("eupl", "european union public|eupl", ""),
    ("artistic", "artistic", "artistic"),
    ("artistic-2.0", "artistic(?: license)? 2(?: 0)?", "artistic"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("boost", "boost software|bsl 1 0", ""),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl|do what the fuck you want to public", ""),
    ("ms-pl", "microsoft public|ms pl", ""),
    ("ms-rl", "microsoft reciprocal|ms rl", ""),
    ("python", "python software foundation|psf", ""),
    ("php", "php", "php"),
    ("ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl"),
    ("postgresql", "postgresql", "postgresql"),
    ("ofl", "sil open font|open font|ofl", ""),
    ("odbl", "open database|odbl", ""),
    ("odc-by", "open data commons attribution|odc by", ""),
    ("pddl", "public domain dedication and|pddl", ""),
    ("cc0", "cc0|creative commons zero", ""),
    ("cc-by", "creative commons attribution|cc by", ""),
    ("cc-by-sa", "creative commons attribution share ?alike|cc by sa", "creative|cc"),
    ("cc-by-nc", "creative commons attribution non ?commercial|cc by nc", "creative|cc"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s?(?: works)?|cc by nd", "creative|cc"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike|cc by nc sa", "creative|cc"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?|cc by nc nd", "creative|cc"),
    ("gfdl", "gnu free documentation|gfdl", ""),
    ("osl", "open software", "open"),
    ("afl", "academic free", "academic"),
    ("ncsa", "ncsa|university of illinois ncsa", "ncsa"),
    ("vim", "vim", "vim"),
    ("w3c", "w3c software(?: notice and)?|w3c", "w3c"),
    ("json", "json", "json"),
    ("beerware", "beer ?ware", "beer|beerware"),
    ("sspl", "server side public|sspl", ""),
    ("busl", "business source|busl", ""),
    ("elastic", "elastic", "elastic"),
)

# Words for a license, and forms in which a name appears: form, pattern, words
# of which it needs one, priority, weight.
_LICENSE = "license|licenses|licence|licences"
FORMS = (
    ("grant", "(?:licensed|released|distributed|available|published|provided) (?:to you )?under (?:the )?(?:terms of )?(?:the )?(?:{})(?: licen[cs]es?)?", "under", 60, 0.95),
    ("terms", "(?:terms|conditions) of (?:the )?(?:{})(?: licen[cs]es?)", _LICENSE, 50, 0.9),
    ("spdx", "spdx license identifier (?:{})", "spdx", 70, 1.0),
    ("header", "licen[cs]e (?:is |under )?(?:the )?(?:{})(?: licen[cs]es?)?", _LICENSE, 30, 0.7),
    ("name", "(?:{}) licen[cs]es?", _LICENSE, 20, 0.6),
)

# Sentences of the licenses themselves; label, pattern, keywords.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission hereby granted charge"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "copyright permission notice copies"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission distribute purpose fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary modification"),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse", "neither contributors endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising materials"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "compliance license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", "unless applicable writing"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "program redistribute modify"),
    ("gpl", "either version [23] of the license or at your option any later version", "either option later"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "library redistribute modify"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "mozilla subject"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors", "implied warranty authors"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", "permission hereby organization"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("ofl", "the fonts and derivatives however cannot be released under any other type of license", "fonts derivatives"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|in ?to|to) the public domain", "public domain"),
    ("proprietary", "all rights reserved", "rights reserved"),
)


@dataclass(frozen=True)
class Rule:
    """One signature; a text needs a word of every set in ``gates`` before ``pattern`` is tried."""

    name: str
    label: str
    pattern: re.Pattern[bytes]
    gates: tuple[frozenset[bytes], ...]
    priority: int
    weight: float


def _rule(name: str, label: str, pattern: str, gates: list[str], priority: int, weight: float) -> Rule:
    return Rule(
        name,
        label,
        re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )"),
        tuple(frozenset(gate.encode().split(b"|")) for gate in gates),
        priority,
        weight,
    )


@cache
def rules() -> tuple[Rule, ...]:
    """All rules from the highest priority down: sentences, the forms of every family, base phrases."""
    out = [
        _rule(f"sentence-{i}", label, pattern, keywords.split(), 80, 1.0)
        for i, (label, pattern, keywords) in enumerate(SENTENCES)
    ]
    out += [_rule(f"base-{label}", label, phrase, phrase.split(), 10, 0.5) for phrase, label in BASE]
    for label, names, keywords in FAMILIES:
        gate = keywords or "|".join(name.split(" ")[0] for name in names.split("|"))
        up = 5 * any(c.isdigit() for c in label)  # a version says more than the family
        for form, pattern, needed, priority, weight in FORMS:
            body = pattern.format(names)
            out.append(_rule(f"{form}-{label}", label, body, [gate, needed], priority + up, weight))
    return tuple(sorted(out, key=lambda r: -r.priority))


@cache
def _by_keyword() -> dict[bytes, list[int]]:
    """The rules that a word of their first gate brings into question."""
    out: dict[bytes, list[int]] = {}
    for i, rule in enumerate(rules()):
        for word in rule.gates[0]:
            out.setdefault(word, []).append(i)
    return out


def matched(words: list[bytes]) -> list[tuple[int, int, int]]:
    """Every find of every rule in normalized words: (first word, word after the last, number of the rule)."""
    present = set(words)
    by_word, table = _by_keyword(), rules()
    asked = {i for word in present.intersection(by_word) for i in by_word[word]}
    tried = [i for i in asked if not any(gate.isdisjoint(present) for gate in table[i].gates)]
    if not tried:
        return []
    text = b" " + b" ".join(words) + b" "
    found = [(m.start(), m.end(), i) for i in sorted(tried) for m in table[i].pattern.finditer(text)]
    if not found:
        return []
    blanks = [j for j, c in enumerate(text) if c == 32]
    return [(bisect.bisect_left(blanks, start) - 1, bisect.bisect_left(blanks, end), i) for start, end, i in found]


def surviving(finds: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Finds that lie in none of higher priority, by place.

    Of equal priority the longest goes first, then the leftmost, then the first rule.
    """
    table = rules()
    starts: list[int] = []  # of the finds taken that lie in no other one: starts and ends both ascend
    ends: list[int] = []
    taken = []
    for start, end, i in sorted(finds, key=lambda f: (-table[f[2]].priority, f[0] - f[1], f[0], f[2])):
        at = bisect.bisect_right(starts, start) - 1
        if at >= 0 and ends[at] >= end:
            continue
        taken.append((start, end, i))
        lo = bisect.bisect_left(starts, start)
        hi = lo
        while hi < len(ends) and ends[hi] <= end:
            hi += 1
        starts[lo:hi], ends[lo:hi] = [start], [end]
    return sorted(taken)


def detect(words: list[bytes]) -> list[tuple[int, int, str, str, float]]:
    """Finds that survive in normalized words: (first word, word after the last, label, rule, weight), by place."""
    table = rules()
    return [(start, end, table[i].label, table[i].name, table[i].weight) for start, end, i in surviving(matched(words))]


def base_places(finds: list[tuple[int, int, int]]) -> list[tuple[int, str]]:
    """Every place of a base phrase, suppressed or not: (word number, label)."""
    table = rules()
    return sorted((start, table[i].label) for start, _, i in finds if table[i].name.startswith("base-"))


def normalized(text: bytes | None) -> list[bytes]:
    """Words of a text after A-Z have been lower-cased; none for null."""
    return _WORD.findall(text.lower()) if text else []


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, finds array<struct<start:int,end:int,label:string,rule:string>>"
)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """License finds per document: ``key`` and the columns of ``SCHEMA``.

    Null and empty texts have no words and no finds. ``finds`` are the places that
    survive suppression (words from 0, end exclusive); ``labels`` joins theirs with
    those of the base phrases; ``score`` is the largest weight of a find, 0 without
    one. One row per input row: repeated rows give repeated results, other columns
    are ignored, a null key stays null.
    """
    schema = docs.select(key).schema.simpleString()[len("struct<") : -1].replace(":", " ", 1)
    found = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("rule", pa.string())])
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in utf8(batch.column(1)):
                words = normalized(body)
                every = matched(words)
                places = base_places(every)
                finds = [(a, b, rules()[i].label, rules()[i].name, rules()[i].weight) for a, b, i in surviving(every)]
                base = sorted({label for _, label in places})
                rows.append(
                    (
                        len(words),
                        len(places),
                        places[0][0] if places else None,
                        places[-1][0] if places else None,
                        ",".join(base),
                        ",".join(sorted({*base, *(f[2] for f in finds)})),
                        max([0.5 * bool(places), *(f[4] for f in finds)]),
                        [{"start": f[0], "end": f[1], "label": f[2], "rule": f[3]} for f in finds],
                    )
                )
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), found)
            columns = zip(*rows, strict=True) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                names=[key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "finds"],
            )

    return docs.select(key, text).mapInArrow(scan, f"{schema}, {SCHEMA}")
