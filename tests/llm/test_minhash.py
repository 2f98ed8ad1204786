import random

import edges
import numpy as np
import pytest

from tamarack.llm import minhash
from tamarack.llm.components import components
from tamarack.llm.minhash import near_components, packed, shingles, signatures, similar


def brute(rows, percent=85):
    """doc_id -> (set size, smallest doc_id that can be reached), every pair compared."""
    sets = {}
    for doc_id, text in rows:
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    above = {d: d for d in sets}

    def top(d):
        while above[d] != d:
            d = above[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(a), top(b)))
                above[q] = p
    return {d: (len(s), top(d)) for d, s in sets.items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near_copies(n=60, seed=8):
    """A spectrum of copies of one text, some of which only reach each other through others."""
    rng = random.Random(seed)
    words = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        own = list(words)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(500 + i, " ".join(f"y{rng.randint(0, 900)}" for _ in range(60))) for i in range(40)]
    rows += [(600 + i, rows[i % 7][1].upper()) for i in range(20)]
    return rows


def test_against_brute_force_in_crowded_regions(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_components(docs, block=16)) == brute(rows)


def test_crowded_regions_go_deeper(spark):
    rows = near_copies(30, seed=3)
    sets = {d: shingles(t.encode()) for d, t in rows}
    labels = packed(signatures(list(sets.values())))
    df = spark.createDataFrame([(d, [int(x) for x in row]) for d, row in zip(sets, labels)], "v long, labels array<long>")
    wide, deep = minhash.regions(df), minhash.regions(df, crowded=5)
    assert deep.groupBy("region").count().agg({"count": "max"}).first()[0] <= wide.groupBy("region").count().agg({"count": "max"}).first()[0]
    assert 0 < deep.count() < wide.count()


def star(seed, n=150):
    """Copies of one text that are similar enough to it alone, each by a hair."""
    rng = random.Random(seed)
    words = [f"w{seed}_{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(1, n + 1):
        own = list(words)
        own[rng.randrange(10, 100)] = f"x{seed}_{i}"
        own[116] = f"z{seed}_{i}"
        rows.append((i, " ".join(own)))
    return rows


def test_links_in_crowded_regions_are_not_lost(spark):
    rows = star(58)
    want = brute(rows)
    assert {c for _, c in want.values()} == {0}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (16, minhash.BLOCK):
        assert found(near_components(docs, crowded=5, block=block)) == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    other = np.concatenate([base[:900], rng.integers(0, 2**63, 100).astype(np.uint64)])
    values = signatures([np.unique(base), np.unique(other)])
    assert (values[0] == values[1]).mean() == pytest.approx(900 / 1100, abs=0.12)


def test_similar_is_exact_at_the_border():
    a = np.arange(100, dtype=np.uint64)
    assert similar(a, a[:85], 85) and not similar(a, a[:84], 85)


def test_odd_rows(spark):
    rows = edges.rows()
    got = edges.collected(near_components(edges.clashing(spark)))
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got if r[0] is not None}
    want = brute([(r[0], r[1]) for r in rows if r[0] is not None])
    assert {d: (r[1], r[2]) for d, r in by_id.items()} == want
    assert all(r[3] == (r[0] == r[2]) for r in by_id.values())
    assert [r[2:] for r in got if r[0] is None] == [(None, False)] * 2


def test_empty_table(spark):
    assert near_components(edges.empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (200, 201), (201, 200)]
    got = {r.v: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)} | {200: 200, 201: 200}
    assert got == want
