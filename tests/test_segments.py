import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamarack.operators import index as ix
from tamarack.operators import search as se
from tamarack.operators import segments as sg

DOCS = [(1, "red red fish"), (2, "blue fish, old fish"), (30, "Red boat"), (4, "..."), (500, "old red boat"), (6, None)]
QUERY = [(1, "fish red boat", "or", True), (2, "old red", "and", False), (3, "new", "or", False)]


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "grown")


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def found(spark, index):
    q = spark.createDataFrame(QUERY, "qid int, text string, mode string, ranked boolean")
    return sorted(map(tuple, se.search_batch(index, q).collect()))


def same_as_one_build(spark, path, rows):
    grown, built = sg.load_segments(spark, path), ix.build_index(frame(spark, rows))
    assert found(spark, grown) == found(spark, built)
    columns = ["term", "doc_id", "doc_len", "tf"]
    assert sorted(map(tuple, grown.postings.select(columns).collect())) == sorted(map(tuple, built.postings.select(columns).collect()))
    assert sorted(map(tuple, grown.docs.select("doc_id", "doc_len").collect())) == sorted(map(tuple, built.docs.collect()))


def test_grows_like_one_build(spark, path):
    sg.create_segments(spark, path, buckets=4)
    same_as_one_build(spark, path, [])
    sg.add_segment(spark, path, frame(spark, DOCS[:2]), "a")
    same_as_one_build(spark, path, DOCS[:2])
    sg.add_segment(spark, path, frame(spark, DOCS[2:]), "b")
    same_as_one_build(spark, path, DOCS)
    sg.add_segment(spark, path, frame(spark, DOCS[2:]), "b")  # the same batch again
    same_as_one_build(spark, path, DOCS)
    sg.add_segment(spark, path, frame(spark, []), "nothing")
    sg.merge_segments(spark, path, "all")
    same_as_one_build(spark, path, DOCS)
    assert sg._state(spark, path)[1][-1]["name"] == "all" and len(sg._state(spark, path)[1]) == 2


def test_replaced_and_deleted(spark, path):
    sg.create_segments(spark, path, buckets=4)
    sg.add_segment(spark, path, frame(spark, DOCS), "a")
    sg.add_segment(spark, path, frame(spark, [(2, "new red boat"), (7, "fish"), (7, "fish"), (None, "lost")]), "b")
    now = [d for d in DOCS if d[0] != 2] + [(2, "new red boat"), (7, "fish")]
    same_as_one_build(spark, path, now)
    sg.delete_documents(spark, path, frame(spark, [(7, ""), (30, ""), (999, "")]))
    now = [d for d in now if d[0] not in (7, 30)]
    same_as_one_build(spark, path, now)
    sg.add_segment(spark, path, frame(spark, [(7, "old fish again")]), "c")  # deleted, and back
    now.append((7, "old fish again"))
    same_as_one_build(spark, path, now)
    sg.merge_segments(spark, path, "all")
    assert sg._state(spark, path)[2].count() == 0
    same_as_one_build(spark, path, now)
    assert sg.drop_unused(spark, path) > 3
    same_as_one_build(spark, path, now)


def test_an_unfinished_version_does_not_count(spark, path):
    sg.create_segments(spark, path, buckets=4)
    sg.add_segment(spark, path, frame(spark, DOCS), "a")
    version, segments, _ = sg._state(spark, path)
    half = spark.createDataFrame([tuple(s) for s in segments[:1]], sg.SEGMENTS)
    half.write.parquet(f"{path}/versions/{version + 1}/segments")  # the job died before the rest
    same_as_one_build(spark, path, DOCS)
    sg.add_segment(spark, path, frame(spark, [(8, "new")]), "b")
    same_as_one_build(spark, path, [*DOCS, (8, "new")])


def test_no_text_is_tokenized_again(spark, path, monkeypatch):
    sg.create_segments(spark, path, buckets=4)
    sg.add_segment(spark, path, frame(spark, DOCS), "a")

    def never(*a, **k):
        raise AssertionError("tokenized")

    monkeypatch.setattr(ix, "_tokens", never)
    sg.delete_documents(spark, path, frame(spark, [(1, "")]))
    sg.merge_segments(spark, path, "b")
    assert sg.load_segments(spark, path).docs.count() == len(DOCS) - 1


def test_an_empty_index_is_saved_and_loaded(spark, tmp_path):
    path = str(tmp_path / "empty")
    ix.save_index(ix.build_index(frame(spark, [])), path, buckets=8)
    assert found(spark, ix.load_index(spark, path)) == []
    listed = str(tmp_path / "listed")
    from tamarack.sources.sinks import write_index

    write_index(ix.index_sorted(ix.token_doc_pairs(frame(spark, []))), listed, buckets=8)
    assert ix.read_index(spark, listed).count() == ix.read_index(spark, listed, "red").count() == 0


def test_no_index(spark, path):
    with pytest.raises(FileNotFoundError):
        sg.load_segments(spark, path)


def test_few_buckets_are_written_by_many_tasks(spark, tmp_path):
    """A bucket is cut into slices of terms, so that tasks don't wait for as many as there are buckets; no row is cut."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("all"), *[F.concat(F.lit(c), F.col("id") % n) for c, n in (("x", 50), ("y", 7), ("z", 200))]).alias("text"))
    key, path = "spark.sql.adaptive.coalescePartitions.enabled", str(tmp_path / "few")
    spark.conf.set(key, "false")  # so little data would be one task's
    try:
        ix.save_index(ix.build_index(docs), path, buckets=2)
    finally:
        spark.conf.set(key, "true")
    files = spark.read.parquet(f"{path}/postings").select("bucket", F.input_file_name().alias("f")).distinct()
    assert min(r.n for r in files.groupBy("bucket").agg(F.count("f").alias("n")).collect()) > 2
    saved = ix.load_index(spark, path)
    want = sorted(map(tuple, ix.build_index(docs).postings.select("term", "doc_id", "doc_len", "tf").collect()))
    assert sorted(map(tuple, saved.postings.select("term", "doc_id", "doc_len", "tf").collect())) == want
    blocks = sorted(map(tuple, ix.impact_blocks(ix.build_index(docs).postings).collect()))
    assert sorted(map(tuple, saved.blocks.select("term", "block", "n", "max_tf", "min_len").collect())) == blocks


def test_rows_put_together_across_batches():
    """Whatever the batches, a row per term and block, unknown blocks included."""
    rows = [("a", 0, 1), ("a", 0, 2), ("a", 1, 130), ("b", 1, 131), ("b", None, None), ("b", None, None), ("c", 0, 5)]
    kinds = pa.schema([("term", pa.string()), ("block", pa.int64()), ("doc_id", pa.int64()), ("doc_len", pa.int64()), ("tf", pa.int64()), ("bucket", pa.int32())])
    table = pa.Table.from_pylist([{"term": t, "block": b, "doc_id": d, "doc_len": 9 - i, "tf": i, "bucket": 3} for i, (t, b, d) in enumerate(rows)], kinds)
    for size in (1, 2, 3, 7):
        got = [r for batch in ix._put_together(iter(table.to_batches(max_chunksize=size))) for r in batch.to_pylist()]
        assert [(r["term"], r["block"], r["n"], r["max_tf"], r["min_len"]) for r in got] == [
            ("a", 0, 2, 1, 8), ("a", 1, 1, 2, 7), ("b", 1, 1, 3, 6), ("b", None, 2, 5, 4), ("c", 0, 1, 6, 3)
        ]
        assert [[e["doc_id"] for e in r["entries"]] for r in got] == [[1, 2], [130], [131], [None, None], [5]]
    assert not list(ix._put_together(iter([])))
