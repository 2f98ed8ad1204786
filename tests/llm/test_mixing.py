import random
import re

import edges
import pytest
from pyspark.sql import functions as F

from tamarack.llm.mixing import BLOCK, mix, quotas, selected, selections, shard_quotas, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def poured(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by sharing out again and again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped = {}, set()
    left = share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        target |= {s: left * weight[s] / total for s in free}
        over = [s for s in free if target[s] > repeats * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = repeats * sizes[s]
            capped.add(s)
            left -= target[s]


def check(spark, docs, rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = poured(sizes)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    taken, source_of = {}, {}
    for doc_id, text, source in rows:
        source_of.setdefault(doc_id, set()).add(source)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        source = None if r.source_key == "1" else r.source_key[1:]
        assert source in source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        taken[source] = taken.get(source, 0) + r.taken
    for source, n in taken.items():
        assert abs(n - want[source]) <= 1.5 * BLOCK
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == sorted(
        tuple(r) for r in mix(docs.repartition(3)).collect() if r.doc_id is not None
    )


def test_documents(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    check(spark, docs, [(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_odd_rows(spark):
    check(spark, edges.frame(spark), [(r[0], r[1], r[3]) for r in edges.rows()])
    assert edges.collected(mix(edges.clashing(spark))) == edges.collected(mix(edges.frame(spark)))
    assert mix(edges.empty(spark)).count() == 0


def test_small_sources_come_near_their_targets(spark):
    """Sources of a few words beside large ones: all are taken to within half a word in two."""
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 400)), "a large") for i in range(200)]
    for s, n in enumerate((1, 2, 3, 6, 17, 40, 90)):
        rows.append((1000 + s, " ".join(["w"] * n), f"small {s}"))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = poured(sizes)
    taken = {}
    for r in mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        taken[r.source_key[1:]] = taken.get(r.source_key[1:], 0) + r.taken
    for source, n in taken.items():
        assert abs(n - want[source]) <= max(0.5, 0.1 * want[source]) and n > 0


def test_selected_blocks_fill_the_quotas_of_the_shards(spark):
    """Every shard's blocks one by one, against the arithmetic."""
    sizes = spark.createDataFrame([(f"0s{i}", 50 + 977 * i) for i in range(12)], "source_key string, size long")
    plan = selections(quotas(targets(sizes), block=8), shards=5)
    for r in plan.collect():
        chosen = set()
        assert sum(s.n for s in r.shards) == r.blocks and sum(s.quota for s in r.shards) == r.quota
        for s in r.shards:
            own = {s.first + b for b in range(s.n) if (b + 1 + s.start) * s.quota // s.n > (b + s.start) * s.quota // s.n}
            assert len(own) == s.quota
            chosen |= own
        places = [0, 1, 7, 8, 9, 8 * r.blocks // 2 + 3, 8 * r.blocks - 1, 8 * r.blocks, 8 * r.blocks + 5]
        one = plan.filter(F.col("source_key") == r.source_key)
        got = one.select(*[selected(F.lit(w).cast("long"), F.col("shards"), 8).alias(f"c{i}") for i, w in enumerate(places)]).first()
        assert list(got) == [sum(max(0, min(8, w - 8 * b)) for b in chosen) for w in places]


def test_one_source_with_nothing_to_take(spark):
    rows = [(1, "", "a"), (2, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [(r.size, r.source_size, r.target, r.taken) for r in mix(docs).collect()] == [(0, 0, 0.0, 0)] * 2


def test_quotas_are_the_highest_quotients(spark):
    sizes = spark.createDataFrame([(f"0s{i}", 100 + 977 * i * i) for i in range(40)], "source_key string, size long")
    plan = quotas(targets(sizes)).collect()
    quotients = sorted(((r.target / (2 * j - 1), r.source_key) for r in plan for j in range(1, r.blocks + 1)), reverse=True)
    seats = sum(r.quota for r in plan)
    won = {}
    for _, s in quotients[:seats]:
        won[s] = won.get(s, 0) + 1
    assert {r.source_key: r.quota for r in plan if r.quota} == won


def test_shard_quotas_are_even(spark):
    sizes = spark.createDataFrame([(f"0s{i}", 100 + 977 * i) for i in range(15)], "source_key string, size long")
    plan = quotas(targets(sizes))
    per = shard_quotas(plan, 7).collect()
    by_source, by_shard = {}, {}
    for r in per:
        by_source.setdefault(r.source_key, []).append(r.blocks)
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.blocks
    assert {s: sum(b) for s, b in by_source.items()} == {r.source_key: r.quota for r in plan.collect()}
    assert all(max(b) - min(b) <= 1 for b in by_source.values())
    assert max(by_shard.values()) - min(by_shard.values()) <= 1


def test_no_python_in_the_plan(spark, root, capsys):
    mix(spark.read.parquet(f"{root}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
