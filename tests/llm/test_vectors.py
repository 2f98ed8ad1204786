import math
import random

import numpy as np
import pytest

from tamarack.llm.nearest import block_best, nearest, quantized
from tamarack.llm.topk import top_k

KINDS = "vec_id long, embedding array<float>, label int"


def vectors(n=300, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, dim)).astype(np.float32)
    x[50:120] = x[50]  # one common vector
    x[7] = x[8] * 2
    return [(i, [float(v) for v in x[i]], i % 3) for i in range(n)]


ODD = [
    (None, [1.0] * 24, 0),
    (1000, None, 0),
    (1020, [], 0),
    (1040, [0.0] * 24, 0),
    (1060, [None] + [1.0] * 23, 0),
    (1080, [math.nan] + [1.0] * 23, 0),
    (1100, [math.inf] + [1.0] * 23, 0),
    (1120, [1.0, 2.0], 0),  # of another length
    (1140, [2.0, -1.0], 0),
    (1160, [1.0] * 24, 0),
    (1160, [1.0] * 24, 1),  # a repeated row
]


def brute(rows, every, k, value, zero_counts):
    usable = {}
    for i, v, _ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not (zero_counts or any(v)):
            continue
        usable[i] = min(usable.get(i, v), v)
    out = []
    for q, a in usable.items():
        if q % every:
            continue
        scored = []
        for i, b in usable.items():
            if i != q and len(a) == len(b):
                scored.append((-value(a, b), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def whole(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


def queries(df, every):
    return df.filter(f"vec_id % {every} = 0")


def test_nearest_is_exact(spark):
    rows = vectors() + ODD
    df = spark.createDataFrame(rows, KINDS)
    got = sorted(tuple(r) for r in nearest(df, queries(df, 20), k=20).collect())
    assert got == brute(rows, 20, 20, product, zero_counts=False)


def test_nearest_over_many_blocks(spark, monkeypatch):
    from tamarack.llm import nearest as module

    real = module.meet_blocks
    monkeypatch.setattr(module, "meet_blocks", lambda *a: real(*a, query_block=7, data_block=40))
    rows = vectors(200, 8, seed=4)
    df = spark.createDataFrame(rows, KINDS)
    got = sorted(tuple(r) for r in nearest(df, queries(df, 10), k=5).collect())
    assert got == brute(rows, 10, 5, product, zero_counts=False)


def test_quantization_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (60, 32)) * rng.uniform(0.01, 100, (60, 1))
    small, scale, kept, lost = quantized(x)
    for i in range(60):
        for j in range(60):
            about = float(small[i].astype(int) @ small[j].astype(int)) * scale[i] * scale[j]
            bound = np.linalg.norm(x[i]) * lost[j] + lost[i] * kept[j]
            assert abs(about - x[i] @ x[j]) <= bound * (1 + 1e-9) + 1e-9


def test_block_best_of_few_candidates():
    ids = np.array([1, 2, 3])
    x = np.array([[1.0, 0], [0, 1], [1, 1]])
    assert block_best(np.array([2]), x[1:2], ids, x, 5) == [(2, 3, 1.0), (2, 1, 0.0)]


def test_top_k_is_exact(spark):
    rows = vectors(seed=2) + ODD
    df = spark.createDataFrame(rows, KINDS)
    got = sorted(tuple(r) for r in top_k(df, queries(df, 50), k=5).collect())
    # whole numbers of a zero vector are zero, and take part
    assert got == brute(rows, 50, 5, whole, zero_counts=True)


def test_top_k_with_ties(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.choice((0, 0.25, 0.5))) for _ in range(3)], 0) for i in range(150)]
    df = spark.createDataFrame(rows, KINDS)
    got = sorted(tuple(r) for r in top_k(df, queries(df, 5), k=7).collect())
    assert got == brute(rows, 5, 7, whole, zero_counts=True)


@pytest.mark.parametrize("search", [nearest, top_k])
def test_empty_tables(spark, search):
    none = spark.createDataFrame([], KINDS)
    df = spark.createDataFrame(vectors(60, 4), KINDS)
    assert search(none, none).count() == 0
    assert search(df, none).count() == 0
    assert search(none, df).count() == 0


@pytest.mark.parametrize("search", [nearest, top_k])
def test_clashing_columns(spark, search):
    rows = vectors(70, 4, seed=9)
    df = spark.createDataFrame(rows, KINDS)
    more = df.selectExpr("*", "1 as query_id", "2 as rank", "3.0 as score", "'x' as v", "4 as dim", "5 as upper")
    a = search(df, queries(df, 20), 3)
    b = search(more, queries(more, 20), 3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
