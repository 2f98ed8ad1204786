import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def test_linear_time_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    width = quality.BUCKETS + quality.STRUCTURE
    machine = quality.Machine(
        0.3, rng.normal(0, 0.3, width), rng.normal(0, 0.3, (width, quality.FACTORS)),
        rng.normal(0, 1, quality.STRUCTURE), rng.uniform(0.5, 2, quality.STRUCTURE),
    )
    at, weights, form = quality.features(b"some words, some more words! 12", None)
    x = np.zeros(width)
    x[at] = weights
    x[quality.BUCKETS :] = np.clip((np.array(form) - machine.mean) / machine.scale, -4, 4) / 4
    total = machine.bias + machine.linear @ x
    for i in range(width):
        if x[i]:
            for j in np.flatnonzero(x[i + 1 :]) + i + 1:
                total += machine.factors[i] @ machine.factors[j] * x[i] * x[j]
    assert machine.score(at, weights, form) == pytest.approx(1 / (1 + np.exp(-total)))


def test_held_out_accuracy(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.classify(docs, quality.train(docs, labels))
    rows = scored.filter(quality.held_out("doc_id")).join(labels, "doc_id").select("score", "predicted", "quality").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.95
    low = [r.score for r in rows if r.quality == 0]
    high = [r.score for r in rows if r.quality == 1]
    wins = sum((a > b) + 0.5 * (a == b) for a in high for b in low)
    assert wins / (len(high) * len(low)) > 0.97


def test_held_out_labels_and_metadata_do_not_matter(spark, root):
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    before = quality.train(docs, labels)
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))
    after = quality.train(renamed, flipped)
    assert np.array_equal(before.factors, after.factors) and before.bias == after.bias


def test_held_out_rows(spark):
    import zlib

    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.h for r in ids.select("doc_id", quality.held_out("doc_id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def test_sample_is_bounded(spark, root):
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    small = quality.train(docs, labels, train_rows=10)
    assert np.isfinite(small.factors).all()


def test_odd_rows(spark):
    docs = edges.frame(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (3, 0, 0), (6, 1, 0), (7, 0, None), (8, None, 0), (9, 7, 0), (None, 1, 0), (2, 0, 0)], LABELS
    )
    machine = quality.train(docs, labels)
    got = quality.classify(docs, machine)
    assert got.count() == len(edges.rows())
    assert got.filter("score IS NULL OR isnan(score) OR score < 0 OR score > 1").count() == 0
    clash = quality.classify(edges.clashing(spark), quality.train(edges.clashing(spark), labels))
    assert edges.collected(clash, "doc_id", "score") == edges.collected(got, "doc_id", "score")
    assert quality.classify(edges.empty(spark), machine).count() == 0


def test_without_labels_or_with_one_class(spark):
    docs = edges.frame(spark)
    none = quality.train(docs, spark.createDataFrame([], LABELS))
    assert {round(r.score, 6) for r in quality.score(docs, none).collect()} == {0.5}
    one = quality.train(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS))
    assert min(r.score for r in quality.score(docs, one).collect()) > 0.9
