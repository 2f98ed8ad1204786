import random
import re

import edges
import pytest

from tamarack.llm.phrases import Shard, remove_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=20):
    """doc_id -> (words, removed, kept) for distinct ids, every window compared."""
    first, removed = {}, {}
    for doc_id, text in sorted(rows):
        words = WORD.findall(text or "")
        removed[doc_id] = set()
        for p in range(len(words) - window + 1):
            if first.setdefault(tuple(words[p : p + window]), (doc_id, p)) != (doc_id, p):
                removed[doc_id].update(range(p, p + window))
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        kept = [w for i, w in enumerate(words) if i not in removed[doc_id]]
        out.append((doc_id, len(words), len(words) - len(kept), " ".join(kept)))
    return sorted(out)


def corpus(seed=1):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]

    def noise(n):
        return [rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(n)]

    rows = []
    for i in range(80):
        words = noise(rng.randint(0, 60))
        if i % 3 == 0:
            a = rng.randint(0, 35)
            words += passage[a : a + rng.randint(18, 25)] + noise(rng.randint(0, 30))
        if i % 7 == 0:
            words += ["same"] * rng.randint(15, 50)
        rows.append((i, " ".join(words)))
    rows += [(100 + i, rows[i % 9][1]) for i in range(30)]
    return rows + [(200, ""), (201, None), (202, " ".join(passage[:19])), (203, "é " * 45)]


@pytest.mark.parametrize("shard_bytes", [1 << 24, 2000])
def test_against_brute_force(spark, shard_bytes):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs, shard_bytes=shard_bytes).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_documents(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    got = remove_repeats(docs, shard_bytes=1 << 17).collect()
    assert sorted(tuple(r) for r in got) == brute([tuple(r) for r in docs.collect()])


def test_automaton_locates_every_recurring_anchor():
    texts = [t.encode() for _, t in corpus(4) if t]
    shard = Shard(texts, 20, 6)
    grams, at = shard.anchors()
    some = grams[at[::3]]
    located = shard.located(some)
    assert located[::3].all()
    assert (located == [g in set(some.tolist()) for g in grams[at].tolist()]).all()


def test_odd_rows(spark):
    rows = edges.rows()
    got = edges.collected(remove_repeats(edges.clashing(spark), shard_bytes=30000))
    assert len(got) == len(rows)
    assert got == edges.collected(remove_repeats(edges.frame(spark)))
    by_id = [r for r in got if r[0] is not None and r[0] != 2]
    want = brute([(r[0], r[1]) for r in rows if r[0] is not None and r[0] != 2])
    assert sorted(by_id) == want
    n = len(WORD.findall(rows[0][1]))
    assert [r[1:3] for r in got if r[0] == 2] == [(n, n), (n, n)]
    assert remove_repeats(edges.empty(spark)).count() == 0


def test_rows_without_id_come_last(spark):
    text = " ".join(f"t{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (None, text), (5, text + " more")], "doc_id long, text string")
    got = {(r.doc_id, r.n_removed) for r in remove_repeats(docs).collect()}
    assert got == {(5, 0), (None, 30)}
    alone = spark.createDataFrame([(None, text), (None, text)], "doc_id long, text string")
    assert {r.n_removed for r in remove_repeats(alone).collect()} == {0}


def test_rows_without_id_repeat_themselves(spark):
    passage = " ".join(f"t{i}" for i in range(25))
    text = f"{passage} between {passage} after"
    docs = spark.createDataFrame([(None, text), (None, text), (None, passage)], "doc_id long, text string")
    got = sorted(tuple(r) for r in remove_repeats(docs).select("n_words", "n_removed", "kept").collect())
    assert got == [(25, 0, passage)] + [(52, 25, f"{passage} between after")] * 2
