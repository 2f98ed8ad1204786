import hashlib
import math
import random

import numpy as np

from tamarack.llm import codes

KINDS = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4, factor=1024):
    """Every part against every entry, in Python numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(factor * x) for x in v], t) for i, v, t in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[j * width : (j + 1) * width] for j in range(parts)] for _, v, _ in kept]
    books = [[c[j] for c in cut[:entries]] for j in range(parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(c[j], e)), i) for i, e in enumerate(books[j])) for j in range(parts)]
            for c in cut
        ]

    for _ in range(rounds):
        found = assign()
        for j in range(parts):
            members = {}
            for c, f in zip(cut, found):
                members.setdefault(f[j][1], []).append(c[j])
            for i, m in members.items():
                books[j][i] = [sum(col) // len(m) for col in zip(*m)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, t), e in zip(kept, errors):
        by_label[t] = by_label.get(t, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        [
            (r[0], "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], digest)
            for r, f, e in zip(kept, found, errors)
        ],
        key=str,
    )


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [round(rng.gauss(0, 1), 2) for _ in range(8)], rng.choice((0, 1, None))) for i in range(120)]
    rows += [(500 + i, list(rows[i][1]), 2) for i in range(40)]  # copies
    rows += [(None, [0.5] * 8, 1), (3, [0.0] * 8, 1), (900, None, 1), (901, [None] + [1.0] * 7, 1), (902, [math.inf] * 8, 1)]
    rows += [(903, [math.nan] * 8, None), (904, [3e4] * 8, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted((tuple(r) for r in codes.encode(df, entries=16).collect()), key=str)
    assert got == brute(rows, entries=16)


def test_moved_entries_only_give_what_a_whole_scan_gives():
    """Small numbers, so that many distances tie."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        x = rng.integers(-3, 4, (80, 2)).astype(np.int32)
        entries = rng.integers(-3, 4, (12, 2))
        at, far = codes.nearest_of(x, entries)
        after = entries.copy()
        some = rng.random(12) < 0.3
        after[some] = rng.integers(-3, 4, (some.sum(), 2))
        moved = (after != entries).any(axis=1)
        want = codes.nearest_of(x, after)
        got = codes.reassigned(x, after, moved, at, far)
        assert (want[0] == got[0]).all() and (want[1] == got[1]).all()


def test_fixed_parts_meet_moved_entries_only(monkeypatch):
    """The stored distance replaces the scan of entries that stayed."""
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (300, 4)).astype(np.int32)
    entries = rng.integers(-50, 50, (32, 4))
    at, far = codes.nearest_of(x, entries)
    moved = np.zeros(32, bool)
    moved[5] = True
    after = entries.copy()
    after[5] += 1
    seen = []
    real = codes.distances
    monkeypatch.setattr(codes, "distances", lambda a, b: seen.append(len(a) * len(b)) or real(a, b))
    codes.reassigned(x, after, moved, at, far)
    own = int((at == 5).sum())
    assert sum(seen) == own * 32 + (300 - own)


def test_distances_beyond_doubles():
    x = np.array([[2**27, -(2**27)], [2**27 - 1, 5]], np.int32)
    e = np.array([[-(2**27), 2**27], [3, 4]], np.int64)
    want = [[sum((int(p) - int(q)) ** 2 for p, q in zip(a, b)) for b in e] for a in x]
    assert codes.distances(x, e).tolist() == want
    assert 64 * (2 * codes.largest(64)) ** 2 <= 2**62


def test_odd_tables(spark):
    none = codes.encode(spark.createDataFrame([], KINDS))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert none.count() == 0
    odd = spark.createDataFrame([(1, [], 0), (2, None, 0), (None, [], None)], KINDS)
    assert sorted((tuple(r)[:4] for r in codes.encode(odd).collect()), key=str) == [
        (1, None, None, None), (None, None, None, None),
    ]
    mixed = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 0), (2, [1.0], 0), (3, [1.0, 2.0, 3.0], 0), (4, [9e30, 0.0, 0.0], 1)], KINDS)
    got = {r[0]: tuple(r)[1:4] for r in codes.encode(mixed).collect()}
    assert got[1] == got[3] == ("00000000", 0, 0)
    assert got[2] == (None, None, 0)  # of another length
    assert got[4][1] == 0


def test_clashing_columns(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in rng.normal(0, 1, 8)], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, KINDS)
    more = df.selectExpr("*", "1 as key", "2 as tag", "3 as x", "'y' as at", "4 as far", "5 as error", "'z' as code")
    a, b = codes.encode(df, entries=8), codes.encode(more, entries=8)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
