import random

import edges
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarack.llm.pieces import PieceModel, decode_pieces, encode_pieces, round_trip

PATH = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def raw():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def pieces(raw):
    return PieceModel(raw)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("abcdeghinorst THE.,!?'\n\t0123é漢字ßя☃==--"), max_size=120))
def test_same_ids_as_the_library(pieces, library, text):
    assert pieces.encode(text).tolist() == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=80))
def test_round_trip_of_any_text(pieces, text):
    text = text.encode("utf-8", "replace").decode()
    assert pieces.decode(pieces.encode(text).tolist()) == text


def test_documents_as_the_library_has_them(spark, root, pieces, library):
    texts = [r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    for text in texts:
        assert pieces.encode(text).tolist() == library.encode(text)


def test_window_stays_bounded_and_commits_early(pieces, library):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghij0123=-") for _ in range(20000))
    sizes = []
    ids = pieces.search(text, sizes)
    assert max(sizes) < 40 * pieces.longest
    assert "".join(pieces.pieces[i] for i in ids) == text
    assert [i for i in pieces.encode(text).tolist()] == library.encode(text)


def test_unigram_takes_the_largest_sum(raw):
    model = PieceModel(raw, "unigram")
    model.ids = {p: i for i, p in enumerate(["a", "b", "ab", "ba", "aba", "bb"])}
    model.scores = [-1.0, -1.5, -1.7, -1.6, -2.0, -2.9]
    model.pieces = list(model.ids)
    model.ends = {p[k:]: -1 for p in model.ids for k in range(1, len(p))} | model.ids
    model.longest = 3

    def brute(text):
        if not text:
            return 0.0, []
        best = None
        for k in range(1, min(3, len(text)) + 1):
            if text[:k] in model.ids:
                value, rest = brute(text[k:])
                value += model.scores[model.ids[text[:k]]]
                if best is None or value > best[0]:
                    best = (value, [model.ids[text[:k]], *rest])
        return best

    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 13)))
        assert sum(model.scores[i] for i in model.search(text)) == pytest.approx(brute(text)[0])
    long = "".join(rng.choice("ab") for _ in range(500))
    cut = model.search(long)
    assert "".join(model.pieces[i] for i in cut) == long


def test_odd_rows(spark):
    docs = edges.frame(spark)
    coded = decode_pieces(encode_pieces(docs, PATH), PATH)
    assert coded.columns == [*docs.columns, "ids", "decoded"]
    assert coded.filter("NOT (decoded <=> text)").count() == 0
    assert coded.filter("text IS NULL AND ids IS NOT NULL").count() == 0
    assert coded.filter("text = '' AND size(ids) <> 0").count() == 0
    assert coded.count() == len(edges.rows())
    clash = round_trip(edges.clashing(spark), PATH)
    assert edges.collected(clash, "doc_id", "ids", "decoded") == edges.collected(coded, "doc_id", "ids", "decoded")
    assert round_trip(edges.empty(spark), PATH).count() == 0


def test_unknown_ids_add_nothing(spark):
    df = spark.createDataFrame([([1000, 10**8, -5, None],), (None,), ([],)], "ids array<int>")
    got = [r.decoded for r in decode_pieces(df, PATH).collect()]
    assert got[1:] == [None, ""] and got[0] is not None


def test_documents_go_through_the_streaming_search(spark, root, raw):
    """Every id of a document is committed by the search, in a window bounded by the longest piece."""
    model = PieceModel(raw, cached=1)
    windows, given = [], []

    def search(segment):
        ids = PieceModel.search(model, segment, windows)
        given.extend(ids)
        return ids

    model._remembered.search = search
    texts = [r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect() if r.text]
    n = sum(len(model.encode(t)) for t in texts)
    assert len(given) > n / 2 and len(windows) > len(texts)  # the rest are stretches remembered at once
    assert max(windows) <= 6 * model.longest
