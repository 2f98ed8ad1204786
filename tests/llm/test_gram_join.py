import random
import re

import edges
import numpy as np
import pytest

from tamarack.llm import gram_join
from tamarack.llm.gram_join import cell_keys, jaccard_components


def word_sets(rows, size=4):
    sets = {}
    for doc_id, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
        sets[doc_id] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    return sets


def brute(rows, percent=85):
    """doc_id -> (set size, smallest doc_id that can be reached), every pair compared."""
    sets = word_sets(rows)
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


def family(seed, words, copies, edits, start=0):
    """Copies of one text with up to ``edits`` words changed, so that some reach others only through third ones."""
    rng = random.Random(seed)
    base = [f"w{seed}_{rng.randint(0, 5000)}" for _ in range(words)]
    rows = []
    for i in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"x{rng.randint(0, 10**6)}"
        rows.append((start + i, " ".join(own)))
    return rows


def corpus():
    """Families at the threshold, short texts, and a passage that unlike texts share."""
    rng = random.Random(5)
    rows = family(1, 120, 50, 6) + family(2, 40, 40, 2, 100) + family(3, 12, 40, 1, 200) + family(4, 600, 12, 30, 300)
    shared = " ".join(f"common{i}" for i in range(40))
    for i in range(60):
        own = " ".join(f"y{rng.randint(0, 900)}" for _ in range(rng.randint(4, 40)))
        rows.append((400 + i, f"{shared} {own}"))
    rows += [(500 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))) for i in range(80)]
    rows += [(600 + i, rows[i % 7][1].upper()) for i in range(10)]
    return rows


@pytest.fixture(scope="module")
def truth():
    return brute(corpus())


@pytest.mark.parametrize("node", [16, gram_join.NODE])
def test_against_brute_force(spark, truth, node):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(4)
    assert found(jaccard_components(docs, node=node)) == truth
    assert len({c for _, c in truth.values()}) < len(truth) - 60


def star(n=150):
    """Copies of one text that are similar enough to it alone, each by a hair."""
    rng = random.Random(58)
    words = [f"w{i}" for i in range(160)]
    rows = [(0, " ".join(words))]
    for i in range(1, n + 1):
        own = list(words)
        for place in (rng.randrange(10, 60), rng.randrange(70, 140)):
            own[place] = f"x{i}_{place}"
        own[156] = f"z{i}"
        rows.append((i, " ".join(own)))
    return rows


def test_links_to_one_text_alone_are_found(spark, monkeypatch):
    rows = star()
    want = brute(rows)
    assert {c for _, c in want.values()} == {0}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(gram_join, "TEXTS", 16)
    for node in (16, gram_join.NODE):
        assert found(jaccard_components(docs, node=node)) == want


def random_pair(rng, n, percent):
    """Two sets that are linked by a hair."""
    a = rng.choice(2**62, n, replace=False).astype(np.uint64)
    most = n - -(-2 * n * percent // (100 + percent))
    gone = int(rng.integers(0, most + 1))
    b = np.concatenate([a[gone:], rng.choice(2**62, int(rng.integers(0, n)), replace=False).astype(np.uint64)])
    while 100 * (n - gone) < percent * (len(b) + gone):
        b = b[:-1]
    return np.unique(a), np.unique(b)


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_share_a_cell(percent):
    rng = np.random.default_rng(percent)
    pairs = [random_pair(rng, int(n), percent) for n in rng.integers(1, 400, 600)]
    of, key = cell_keys([s for p in pairs for s in p], percent)
    cells = [set(key[of == i].tolist()) for i in range(2 * len(pairs))]
    different = 0
    for i, (a, b) in enumerate(pairs):
        if gram_join.linked(a, b, percent) and not np.array_equal(a, b):
            different += 1
            assert cells[2 * i] & cells[2 * i + 1]
    assert different > 200
    sizes = np.array([len(s) for p in pairs for s in p])
    assert len(key) < 0.35 * sizes.sum() + 4 * len(sizes)


def test_linked_short_sets_share_a_cell():
    """Every pair of subsets of a few shingles."""
    rng = np.random.default_rng(7)
    for n in range(1, 40):
        base = rng.choice(2**62, n + 6, replace=False).astype(np.uint64)
        sets = [np.unique(base[rng.random(n + 6) < 0.9]) for _ in range(40)]
        of, key = cell_keys(sets, 85)
        cells = [set(key[of == i].tolist()) for i in range(len(sets))]
        for i in range(len(sets)):
            for j in range(i):
                if len(sets[i]) and gram_join.linked(sets[i], sets[j], 85) and not np.array_equal(sets[i], sets[j]):
                    assert cells[i] & cells[j]


def test_tree_join_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    base = rng.poisson(4, (12, gram_join.DIMS))
    points = np.concatenate([b + rng.poisson(0.1, (25, gram_join.DIMS)) for b in base]).astype(np.uint8)
    n = points.sum(1).astype(np.int64)
    root = np.where(rng.random(len(n)) < 0.3, 1, np.arange(len(n)) + 5)
    bound = np.minimum(points[:, None], points[None]).sum(2, dtype=np.int64)
    ok = (185 * bound >= 85 * (n[:, None] + n)) & (root[:, None] != root)
    ok &= (100 * np.minimum(n[:, None], n) >= 85 * np.maximum(n[:, None], n))
    tree = gram_join.Tree(points, n, root)
    i, j = gram_join.tree_join(tree, tree, 85)
    got = {(min(p, q), max(p, q)) for p, q in zip(i.tolist(), j.tolist())}
    assert len(got) == len(i)
    assert got == {(p, q) for p, q in zip(*map(np.ndarray.tolist, np.nonzero(ok))) if p < q}
    half = gram_join.Tree(points[:130], n[:130], root[:130]), gram_join.Tree(points[130:], n[130:], root[130:])
    i, j = gram_join.tree_join(*half, 85)
    assert set(zip(i.tolist(), (j + 130).tolist())) == {(p, q) for p, q in got if p < 130 <= q}


def test_bounds_prune_nodes(monkeypatch):
    """Far fewer bounds are computed than there are pairs."""
    rng = np.random.default_rng(4)
    base = rng.poisson(6, (8, gram_join.DIMS))
    points = np.concatenate([b + rng.poisson(0.02, (128, gram_join.DIMS)) for b in base]).astype(np.uint8)
    seen = []
    real = gram_join.within_bounds
    monkeypatch.setattr(gram_join, "within_bounds", lambda *a: seen.append(len(a[2])) or real(*a))
    tree = gram_join.Tree(points, points.sum(1).astype(np.int64), np.arange(len(points)))
    gram_join.tree_join(tree, tree, 85)
    assert sum(seen) < len(points) * (len(points) - 1) // 2 // 4


def test_hot_cells_lie_in_many_slices(spark):
    """A cell that every set has, over many small slices."""
    rows = [(i, [7, 1000 + i % 40, 5000 + i]) for i in range(400)]
    df = spark.createDataFrame(rows, "set_id long, cells array<long>")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = gram_join.shared_cells(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    held = {}
    for r in got:
        held.setdefault(r.key, []).append(r.v)
        assert r.pivot <= r.v
    assert sorted(held[7]) == list(range(400))
    assert all(sorted(held[1000 + c]) == [i for i in range(400) if i % 40 == c] for c in range(40))
    assert sum(k >= 5000 for k in held) <= 26


def test_odd_rows(spark):
    rows = edges.rows()
    got = edges.collected(jaccard_components(edges.clashing(spark)))
    assert len(got) == len(rows)
    want = brute([(r[0], r[1]) for r in rows if r[0] is not None])
    assert {r[0]: (r[1], r[2]) for r in got if r[0] is not None} == want
    assert [r[2] for r in got if r[0] is None] == [None] * 2


def test_empty_table(spark):
    assert jaccard_components(edges.empty(spark)).count() == 0


def test_full_coordinates_bound_nothing():
    sets = [np.arange(n, dtype=np.uint64) * np.uint64(2**47) for n in (300 * 256, 300 * 256 - 9, 200)]
    sets = [np.concatenate([s[:100], s[100:] % np.uint64(2**56)]) for s in sets]  # most in one group
    points = gram_join.points_of(sets)
    assert points[0].max() == gram_join.FULL == points[1].max()
    bound = gram_join.overlap_bound(points[[0, 0]], points[[1, 2]])
    assert bound[0] > 300 * 256 and bound[1] <= 200
