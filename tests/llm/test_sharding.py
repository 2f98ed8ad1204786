import random
import zlib
from itertools import combinations

import edges
import pytest

from tamarack.llm.sharding import propagate, shard_rows


def check(rows, got, shards=16):
    assert len(got) == len(rows)
    by_shard = {s: [] for s in range(shards)}
    for r in got:
        by_shard[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    counts = [len(slots) for slots in by_shard.values()]
    assert max(counts) - min(counts) <= 1
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want


def test_documents(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = shard_rows(docs).collect()
    check(rows, got)
    groups, shard = {}, {r.doc_id: r.shard for r in got}
    for d, t in rows:
        groups.setdefault(t, set()).add(shard[d])
    cut = [t for t, s in groups.items() if len(s) > 1]
    assert len(cut) <= 1
    assert sorted(map(str, got)) == sorted(map(str, shard_rows(docs.repartition(5)).collect()))


def test_a_group_with_a_third_of_all_rows(spark):
    rows = [(i, "the same text") for i in range(200)] + [(200 + i, f"text {i // 2}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard_rows(docs).collect()
    check(rows, got)
    shard = {r.doc_id: r.shard for r in got}
    assert len({shard[i] for i in range(200)}) <= 10  # 200 rows fill more than five shards of 37 or 38
    pairs = sum(shard[200 + 2 * i] != shard[201 + 2 * i] for i in range(200))
    assert pairs <= 16


def test_odd_rows(spark):
    docs = edges.frame(spark)
    got = shard_rows(docs)
    check([(r[0], r[1]) for r in edges.rows()], got.collect())
    assert edges.collected(shard_rows(edges.clashing(spark))) == edges.collected(got)
    assert shard_rows(edges.empty(spark)).count() == 0


def test_propagation_over_general_links(spark):
    # Two chains of nodes that share hubs; labels start mixed.
    nodes = [(i, 1, i % 2) for i in range(12)]
    links = [(i, i // 6 * 100 + k) for i in range(12) for k in (i % 6, i % 6 + 1)]
    df = propagate(
        spark.createDataFrame(nodes, "node long, size long, label int"),
        spark.createDataFrame(links, "node long, hub long"),
        capacity=7,
        rounds=10,
        slack=0.0,
    )
    label = {r.node: r.label for r in df.collect()}
    loads = [sum(x == s for x in label.values()) for s in (0, 1)]
    assert max(loads) <= 7 and sum(loads) == 12

    def cut(of):
        return sum(of[a] != of[b] for a, h in links for b, g in links if h == g and a < b)

    assert cut(label) < cut({i: s for i, _, s in nodes})


def split_pairs(groups, shard):
    return sum(shard[a] != shard[b] for g in groups for a, b in combinations(g, 2))


@pytest.mark.parametrize("seed", range(4))
def test_cut_against_the_best_of_all_assignments(spark, seed):
    """Ten documents in two shards of five: every way to deal them."""
    rng = random.Random(seed)
    rows = [(i, f"text {rng.choice('abcd')}") for i in range(10)]
    groups = {}
    for d, t in rows:
        groups.setdefault(t, []).append(d)
    groups = list(groups.values())
    every = [split_pairs(groups, {d: int(d in half) for d, _ in rows}) for half in combinations(range(10), 5)]
    got = {r.doc_id: r.shard for r in shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), shards=2).collect()}
    mean = sum(every) / len(every)
    assert min(every) <= split_pairs(groups, got) <= min(every) + (mean - min(every)) / 2
