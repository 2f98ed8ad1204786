import hashlib
import json
import random

import numpy as np
import pytest
import sentencepiece
import tokenizers
from edges import clashing, collected, empty, frame

from tamarack.llm import alignment
from tamarack.llm.queries import BYTE_TOKENIZER, TOKENIZER

FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)


def letter_bytes():
    """The table of byte-level vocabularies, by its public rule."""
    plain = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table, extra = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def spelled(libraries, text):
    """(id, bytes) of the A and B tokens, or None."""
    a, b = libraries
    if not text:
        return None
    table = letter_bytes()
    made = a.encode(" " + text, add_special_tokens=False)
    first = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in made.ids]
    second = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in first) != whole or b"".join(x for _, x in second) != whole:
        return None
    return first, second


def ends(tokens):
    out, at = [], 0
    for i, spell in tokens:
        at += len(spell)
        out.append((at, i))
    return out


def brute(libraries, docs):
    counts, found = {}, []
    for doc_id, text in docs:
        both = spelled(libraries, text)
        if both is None:
            found.append((doc_id, [], [], [], []))
            continue
        a, b = ends(both[0]), ends(both[1])
        at_a, at_b = {}, {}
        for e, i in a:
            at_a.setdefault(e, []).append(i)
        for e, i in b:
            at_b.setdefault(e, []).append(i)
        links = [(i, j) for e in sorted(at_a) for i in at_a[e] for j in at_b.get(e, ())]
        for pair in links:
            counts[pair] = counts.get(pair, 0) + 1
        groups, lo = [], 0
        for cut in sorted(set(at_a) & set(at_b)):
            of_a = ",".join(str(i) for e, i in a if lo < e <= cut)
            of_b = ",".join(str(i) for e, i in b if lo < e <= cut)
            groups.append(f"{of_a}|{of_b}")
            lo = cut
        found.append((doc_id, a, b, groups, links))
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    return [
        (
            doc_id, len(a), len(b), len(groups), len(links),
            sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, a, b, groups, links in found
    ]


def odd_texts():
    rng = random.Random(8)
    letters = "ab éü漢字😀▁\t\n'1<|endoftext|>  .,x"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(120)]


def report(df):
    return sorted(map(tuple, alignment.link_report(df, BYTE_TOKENIZER, TOKENIZER).select(*FIELDS).collect()), key=str)


def test_against_brute_force(spark, libraries):
    texts = [None, "", "the <|endoftext|> token", "don't stop", "x" * 3000, "  two  blanks ", "▁", "</s><s>"] + odd_texts()
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, "don't stop"), (None, "hello world")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = report(df)
    assert got == sorted(brute(libraries, docs), key=str)
    assert sum(r[1] == 0 for r in got) > 2 and sum(r[1] > r[3] > 0 for r in got) > 20


def test_documents_against_brute_force(spark, root, libraries):
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert report(docs) == sorted(brute(libraries, rows), key=str)


def test_overlaps_are_all_pairs_that_share_bytes(spark, libraries):
    docs = [(i, t) for i, t in enumerate(odd_texts()[:40])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for r in alignment.align(df, BYTE_TOKENIZER, TOKENIZER).collect():
        both = spelled(libraries, docs[r.doc_id][1])
        if both is None:
            assert r.a_ids == r.b_ids == r.a_sizes == r.a_over == []
            continue
        assert r.a_ids == [i for i, _ in both[0]] and r.b_ids == [i for i, _ in both[1]]
        spans = [[(e - len(s), e) for (e, _), (_, s) in zip(ends(t), t)] for t in both]
        want = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (p, q) in enumerate(spans[1]) if s < q and p < e]
        assert list(zip(r.a_over, r.b_over)) == want
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids)


def test_coalesced_groups():
    rng = np.random.default_rng(2)
    for _ in range(60):
        total = int(rng.integers(1, 40))
        cuts = [np.unique(np.append(rng.integers(1, total + 1, 8), total)) for _ in range(2)]
        (a, b) = cuts
        got_a, got_b = alignment.coalesced(np.append(0, a[:-1]), a, np.append(0, b[:-1]), b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        want = [[sum(c < e for c in common) for e in side.tolist()] for side in (a, b)]
        assert got_a.tolist() == want[0] and got_b.tolist() == want[1]


def test_every_link_has_a_place():
    with open(BYTE_TOKENIZER, "rb") as a, open(TOKENIZER, "rb") as b:
        files = a.read(), b.read()
    words = alignment.Vocabularies(*files)
    assert len(words.pairs) <= int(words.a_size.sum() + 2 * words.b_size.sum())
    assert len(json.loads(files[0])["model"]["vocab"]) <= len(words.a_bytes)
    with_texts = alignment.Aligned(words, [b"one and two", None, b"three", b"\xff"])
    of, pair, times = with_texts.links()
    assert set(of.tolist()) == {0, 2} and (pair < len(words.pairs)).all() and (times > 0).all()


def test_odd_rows(spark, libraries):
    rows = [(r[0], r[1]) for r in frame(spark).collect()]
    want = sorted(brute(libraries, rows), key=str)
    assert report(frame(spark)) == want
    assert report(clashing(spark)) == want
    assert collected(alignment.link_report(empty(spark), BYTE_TOKENIZER, TOKENIZER)) == []
    assert alignment.align(empty(spark), BYTE_TOKENIZER, TOKENIZER).count() == 0


def test_running_counts_find_the_overlaps():
    """Against a binary search, also where a side has no tokens or limits lie outside of it."""
    rng = np.random.default_rng(8)
    for n in (0, 1, 7, 300):
        ends = np.cumsum(rng.integers(1, 6, n))
        limits = rng.integers(0, 1600, 50)
        assert (alignment.reached(ends, limits) == np.searchsorted(ends, limits, "right")).all()
        assert (alignment.reached(ends - 1, ends - 1) == np.arange(n) + 1).all()
    assert len(alignment.reached(np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
