import io
import math
import re
from contextlib import redirect_stdout

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tamarack.operators import index as ix
from tamarack.operators import search as se

DOCS = [(1, "red red fish"), (2, "blue fish, old fish"), (30, "Red boat"), (4, "...")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def run(spark, docs, text, mode, ranked, **options):
    q = spark.createDataFrame([(7, text, mode, ranked)], "qid int, text string, mode string, ranked boolean")
    return [tuple(r) for r in se.search_all(ix.build_index(docs, **options), q).collect()]


def hand(idf_df, tf, length, avg, n=4):
    return math.log(n / idf_df) * 11 * tf / (10 * (0.5 + 0.5 * length / avg) + tf)


def test_bm25_by_hand(spark, docs):
    avg = (2 + 3 + 2 + 0) / 4  # distinct words, and the empty document counts
    fish1, fish2, red1 = hand(2, 1, 2, avg), hand(2, 2, 3, avg), hand(1, 2, 2, avg)
    got = run(spark, docs, "fish red fish", "or", True)
    assert [(r[1], r[2]) for r in got] == [(1, 2), (2, 1)]
    assert [r[3] for r in got] == pytest.approx([fish1 + red1, fish2], abs=1e-6)


def test_total_length(spark, docs):
    avg = (3 + 4 + 2 + 0) / 4
    got = run(spark, docs, "fish", "and", True, length="total")
    assert {r[1]: r[3] for r in got} == pytest.approx({1: hand(2, 1, 3, avg), 2: hand(2, 2, 4, avg)}, abs=1e-6)


def test_and_or(spark, docs):
    assert [r[1] for r in run(spark, docs, "red fish", " AND ", False)] == [1]
    assert [r[1] for r in run(spark, docs, "red fish", " ", False)] == [1]
    assert run(spark, docs, "red unknown", "and", False) == []
    assert [r[1] for r in run(spark, docs, "Red fish blue", " OR ", False)] == [2, 1, 30]
    assert [r[1] for r in run(spark, docs, "red", "and", False)] == [1]
    assert [r[1] for r in run(spark, docs, "red", "and", False, lower=True)] == [1, 30]


def test_topk_and_big_query_table(spark, docs, monkeypatch):
    rows = [(i, "red fish boat", "or", True) for i in range(20)]
    q = spark.createDataFrame(rows, "qid int, text string, mode string, ranked boolean")
    index = ix.build_index(docs)
    want = sorted(map(tuple, se.search_batch(index, q, k=2).collect()))
    assert len(want) == 40
    for place in ("search", "joins"):
        monkeypatch.setattr(f"tamarack.operators.{place}.fits_broadcast", lambda df, *a: False)
    assert sorted(map(tuple, se.search_batch(index, q, k=2).collect())) == want


def test_blocks_join_up_to_whole_lists(spark, docs):
    pairs = ix.token_doc_pairs(docs)
    blocks = ix.index_sorted(pairs, 3).filter("term = 'fish'").orderBy("block").collect()
    assert [(r.block, r.n, r.doc_ids) for r in blocks] == [(0, 2, [1, 2])]
    red = ix.index_single_pass(ix.term_frequency(docs), 1).filter("term = 'red'").first()
    assert [tuple(p) for p in red.postings] == [(1, 2)]
    assert ix.lookup_term(ix.index_sorted(pairs), "nothing").count() == 0


def test_index_difference_is_found(spark, docs):
    a = ix.index_sorted(ix.token_doc_pairs(docs))
    b = ix.index_sorted(ix.token_doc_pairs(docs.filter("doc_id <> 30")), 2)
    assert ix.index_differences(a, b).first()[0] == 2
    assert ix.index_differences(a, a).first()[0] == 0


def test_informative_terms(spark):
    rows = [("a", 1, 0), ("b", 1, 0), ("a", 2, 0), ("z", 3, 1)]
    pairs = spark.createDataFrame(rows, "term string, doc_id int, cluster int")
    sizes = spark.createDataFrame([(0, 2), (1, 1)], "cluster int, n_pages bigint")
    got = sorted(map(tuple, se.informative_terms(pairs, sizes).collect()))
    assert got == [(0, 1, "b", 1, round(math.log(2), 6)), (0, 2, "a", 2, 0.0), (1, 1, "z", 1, 0.0)]


def test_saved_index(spark, docs, tmp_path):
    path = str(tmp_path / "saved")
    ix.save_index(ix.build_index(docs), path, buckets=8)
    loaded = ix.load_index(spark, path)
    q = spark.createDataFrame([(1, "fish red", "or", True)], "qid int, text string, mode string, ranked boolean")
    got = se.search_batch(loaded, q).collect()
    assert got == se.search_batch(ix.build_index(docs), q).collect() and len(got) == 2
    asked = spark.createDataFrame([("fish",)], "term string")
    found = se._asked_postings(loaded, asked)
    assert {(r.term, r.doc_id) for r in found.collect()} == {("fish", 1), ("fish", 2)}
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)


def test_fewer_rows_than_queries_times_documents(spark):
    rows = [(i, "common other " + ("rare " if i % 40 == 0 else "") + ("odd " if i % 50 == 3 else "") + f"w{i}") for i in range(400)]
    index = ix.build_index(spark.createDataFrame(rows, "doc_id bigint, text string"))
    asked = [(1, "common rare", "and", True), (2, "common other rare", "or", True), (3, "common rare odd w7", "or", True)]
    q = spark.createDataFrame(asked, "qid int, text string, mode string, ranked boolean")
    best = se.search_batch(index, q, k=5)
    everything = se.match(index, q)
    order = Window.partitionBy("qid").orderBy(*se.result_order())
    want = everything.withColumn("rank", F.row_number().over(order)).filter("rank <= 5")
    assert sorted(best.select("qid", "rank", "doc_id", "score").collect()) == sorted(
        want.select("qid", F.col("rank").cast("long"), "doc_id", "score").collect()
    )
    assert se.match(index, q, k=5).count() < everything.count() < 3 * 400
    hits, terms = index.postings, se.query_terms(q)
    weights = se._weights(hits, terms, F.lit(400.0), F.lit(4.0), se.K1, se.B)
    looked_at = se.match_rows(hits, weights, True, se.bm25(F.col("idf"), F.col("tf"), F.col("doc_len"), F.lit(4.0), se.K1, se.B), 5)
    assert looked_at.groupBy("qid", "doc_id").count().count() < 3 * 400 / 4


def test_blocks_that_cannot_reach_the_best_are_not_read(spark):
    """A word that is in all blocks, but often enough in one only to reach what a rare word gives."""
    n = 40 * ix.IMPACT_BLOCK
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.lit("common other "),
            F.when(F.col("id") < 30, "rare scarce ").otherwise(""),
            F.when(F.col("id").between(30, 60), "odd odd odd odd odd odd odd odd odd ").when(F.col("id") % 9 == 1, "odd ").otherwise(""),
            F.concat(F.lit("w"), F.col("id")),
        ).alias("text"),
    )
    index = ix.build_index(rows)
    asked = [(1, "rare odd common other", "or", True), (2, "common other rare scarce", "and", True)]
    q = spark.createDataFrame(asked, "qid int, text string, mode string, ranked boolean")
    terms = se.query_terms(q)
    hits = index.postings.join(terms.select("term").distinct(), "term").cache()
    stats = ix.corpus_stats(index.docs).first()
    n_docs, avg_len = F.lit(float(stats.n_docs)), F.lit(stats.avg_len)
    weights = se._weights(hits, terms, n_docs, avg_len, se.K1, se.B)
    share = se.bm25(F.col("idf"), F.col("tf"), F.col("doc_len"), avg_len, se.K1, se.B)
    part = se.bm25(F.lit(1.0), F.col("max_tf"), F.col("min_len"), avg_len, se.K1, se.B)
    blocks = ix.impact_blocks(hits).select("term", "block", part.alias("part"))
    read = se.match_rows(hits, weights, True, share, 10, blocks)
    without = se.match_rows(hits, weights, True, share, 10)
    counts = {r.qid: r["count"] for r in read.groupBy("qid").count().collect()}
    before = {r.qid: r["count"] for r in without.groupBy("qid").count().collect()}
    asked_for = hits.count()
    assert counts[1] < before[1] / 2 < asked_for / 2 and counts[2] < asked_for / 20
    best = se.search_batch(index, q, k=10)
    order = Window.partitionBy("qid").orderBy(*se.result_order())
    want = se.match(index, q).withColumn("rank", F.row_number().over(order).cast("long")).filter("rank <= 10")
    assert sorted(map(tuple, best.collect())) == sorted(map(tuple, want.select(*best.columns).collect()))


def test_block_bounds_hold(spark, docs):
    postings = ix.build_index(docs).postings
    blocks = {(r.term, r.block): r for r in ix.impact_blocks(postings).collect()}
    for r in postings.collect():
        b = blocks[r.term, r.doc_id // ix.IMPACT_BLOCK]
        assert b.max_tf >= r.tf and b.min_len <= r.doc_len
    assert sum(b.n for b in blocks.values()) == postings.count()


def test_tokens_are_counted_inside_their_row(spark):
    """No aggregate holds the pairs of a part of the table; rows that share an id and a length are added up."""
    docs = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None), (4, "x")], "doc_id bigint, text string")
    counted = ix.term_frequency(docs)
    out = io.StringIO()
    with redirect_stdout(out):
        counted.explain()
    assert "Aggregate" not in out.getvalue() and "Exchange" not in out.getvalue()
    assert sorted(map(tuple, counted.collect())) == [("a", 1, 2, 1), ("b", 1, 2, 2), ("x", 4, 1, 1)]
    twice = ix.term_frequency(docs.union(docs.filter("doc_id = 1")), length="total")
    assert sorted(map(tuple, twice.collect())) == [("a", 1, 3, 2), ("b", 1, 3, 4), ("x", 4, 1, 1)]


def test_rows_of_a_document_are_added_up_in_one_task(spark, docs):
    """A query's words are in most documents: its rows, many times the postings, are not dealt out again."""
    hits = ix.term_frequency(docs)
    q = spark.createDataFrame([(1, "red fish", "or", False), (2, "fish boat", "or", True)], "qid int, text string, mode string, ranked boolean")
    weights = se._weights(hits, se.query_terms(q), F.lit(4.0), F.lit(2.0), se.K1, se.B)
    out = io.StringIO()
    with redirect_stdout(out):
        se._plain(hits, weights.drop("df", "most"), True).groupBy("qid", "doc_id").count().explain()
    assert re.findall(r"hashpartitioning\((\w+)#\d+L, \d+\), REPARTITION", out.getvalue()) == ["doc_id"]
    top = out.getvalue().split("REPARTITION")[0]
    assert top.count("Exchange hashpartitioning") == 1


def test_a_saved_index_counts_each_text_once(spark, docs, tmp_path):
    path, seen = str(tmp_path / "once"), spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    ix.save_index(ix.build_index(docs.withColumn("text", F.udf(look)("text"))), path, buckets=8)
    assert seen.value == len(DOCS)
    postings, blocks, buckets = ix.read_postings(spark, path)
    assert buckets == 8 and ix.load_index(spark, path).docs.count() == len(DOCS)
    columns = ["term", "doc_id", "doc_len", "tf"]
    want = ix.term_frequency(docs)
    assert sorted(map(tuple, postings.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    bounds = ["term", "block", "n", "max_tf", "min_len"]
    assert sorted(map(tuple, blocks.select(bounds).collect())) == sorted(map(tuple, ix.impact_blocks(want).select(bounds).collect()))
