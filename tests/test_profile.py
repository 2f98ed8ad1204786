import pytest
from pyspark.sql import functions as F

from tamarack.operators import profile as pf
from tamarack.operators import sketches as sk
from tamarack.operators import tabular as tab
from tamarack.operators.keycluster import cluster_keys
from tamarack.operators.ordering import value_counts


def test_ordinal_median_needs_an_odd_count(spark):
    order = spark.createDataFrame([("f", "lo", 1), ("f", "mid", 2), ("f", "hi", 3)], "feature string, value string, rank int")
    for rows, want in [
        ([("f", "hi", 1), ("f", "lo", 1), ("f", "mid", 1)], "mid"),
        ([("f", "hi", 1), ("f", "lo", 3)], None),
        ([("f", "hi", 2), ("f", "lo", 2), ("f", None, 1)], "hi"),  # a missing row counts and sorts last
    ]:
        counts = spark.createDataFrame(rows, "feature string, value string, n bigint")
        got = pf.ordinal_stats(counts, order).first()
        assert got.median_entry == want and got.rank_range == max(
            {"lo": 1, "mid": 2, "hi": 3}.get(v, 0) for _, v, _ in rows
        ) - 1


def test_profile_levels(spark):
    rows = [(1.0, "x", "lo"), (2.0, "y", "hi"), (None, "y", None)]
    df = spark.createDataFrame(rows, "a double, b string, c string")
    order = spark.createDataFrame([("c", "lo", 1), ("c", "hi", 2)], "feature string, value string, rank int")
    got = {r.feature: r for r in pf.profile_table(df, {"a": "ratio", "b": "nominal", "c": "ordinal"}, order).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.n, a.n_entries, a.n_missing, a.n_unique) == (3, 2, 1, 2)
    assert (a.median, a.mean, a.range, a.iqr, a.mode_number) == (1.5, 1.5, 1.0, 0.5, 1.0)
    assert a.std == pytest.approx(0.70710678)
    assert (b.mode, b.median, b.range, b.std) == ("y", None, None, None)
    assert (c.mode, c.median_entry, c.range, c.mean) == ("hi", "hi", 1.0, None)
    with pytest.raises(ValueError):
        pf.profile_table(df, {"a": "odd"})
    with pytest.raises(ValueError):
        pf.profile_table(df, {"c": "ordinal"})


def test_mode_takes_the_smallest_of_a_tie(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (1,), (2,)], "v int")
    assert pf.mode_smallest(value_counts(df, "v"), "v").first().mode == 1


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,), (None,), (1.0,)], "v double")
    got = {r.bin: r.n for r in pf.histogram(df, "v").collect()}
    assert got == {1: 1, 2: 1, 10: 2, **{i: 0 for i in range(3, 10)}}
    same = pf.histogram(spark.createDataFrame([(4.0,), (4.0,)], "v double"), "v").filter("n > 0").first()
    assert (same.bin, same.n) == (6, 2) and same.lo <= 4.0 < same.hi


def test_numeric_facet_kinds(spark):
    rows = [("5",), (" -2.5 ",), ("hey",), ("1d",), ("",), (None,), ("  ",)]
    df = spark.createDataFrame(rows, "t string")
    full = pf.numeric_facet(df, "t").collect()
    assert {r.kind: r.n for r in full if r.bin is None} == {
        "numeric": 2, "non_numeric": 2, "blank": 3, "min_max": 7,
    }
    part = pf.numeric_facet(df, "t", include=["numeric"]).collect()
    assert [(r.lo, r.hi, r.n) for r in part if r.kind == "min_max"] == [(-2.5, 5.0, 2)]
    assert sum(r.n for r in part if r.kind == "histogram") == 2


def test_box_with_outlier(spark):
    rows = [("g", float(v)) for v in (1, 2, 3, 4, 100)] + [("h", 7.0), (None, 3.0)]
    got = {r.k: r for r in pf.box_summary(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    assert set(got) == {"g", "h"}
    g = got["g"]
    assert (g.q1, g.median, g.q3, g.whisker_lo, g.whisker_hi, g.n_outliers) == (2, 3, 4, 1, 4, 1)


def test_key_clusters(spark):
    rows = [("b a c",), ("a c b a",), ("a c b a",), ("one",), ("two",)]
    got = {r.variant: r for r in cluster_keys(spark.createDataFrame(rows, "t string"), "t").collect()}
    assert got["one"].key == got["two"].key == "" and got["one"].merged == "one" and got["one"].key_rows == 2
    assert got["a c b a"].n == 2


def test_pivots(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 2, None), ("a", 3, 4.0)], "x string, y int, v double")
    got = [tuple(r) for r in tab.pivot_mean_smaller(df, "x", "y", "v").orderBy("y").collect()]
    assert got == [(1, 2.0, 0.0), (3, 4.0, 0.0)]
    cells = {(r.x, r.y): r.v for r in tab.pivot_cells(df, "x", "y", "v").collect()}
    assert cells == {("a", 1): 2.0, ("a", 3): 4.0}


def test_append_is_idempotent(spark):
    history = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "changed"), (2, "b"), (2, "b"), (None, "x"), (None, "y")], "k int, v string")
    want = [(None, "x"), (1, "a"), (2, "b")]
    for _ in range(3):
        history = tab.append_unseen(history, batch, "k")
        assert sorted(map(tuple, history.collect()), key=str) == sorted(want, key=str)


def test_sparse_pivot_of_many_columns(spark):
    """100,000 names of columns, none of which is a column."""
    df = spark.range(200_000).select((F.col("id") % 2).alias("r"), F.floor(F.col("id") / 2).alias("c"), F.col("id").cast("double").alias("v"))
    wide = tab.pivot_sparse(df.unionByName(df.filter("c < 3").withColumn("v", F.col("v") + 1)), "r", "c", "v")
    got = {r.r: r.cells for r in wide.collect()}
    assert len(got[0]) == len(got[1]) == 100_000
    assert got[1][0] == 1.5 and got[0][99_999] == 199_998.0 and list(got[0])[:3] == [0, 1, 2]
    odd = spark.createDataFrame([("a", None, 1.0), (None, 1, 1.0), ("a", 1, None), ("b", 2, 1.0)], "r string, c int, v double")
    assert [tuple(r) for r in tab.pivot_sparse(odd, "r", "c", "v").collect()] == [("b", {2: 1.0})]
    assert tab.pivot_sparse(odd.limit(0), "r", "c", "v").count() == 0


def test_stored_rows_do_not_move(spark, tmp_path):
    stored = spark.range(2000).select((F.col("id") * 3).alias("k"), F.lit("old").alias("v")).unionByName(
        spark.createDataFrame([(None, "old")], "k bigint, v string")
    )
    tab.store_bucketed(stored, "stored_rows", str(tmp_path / "stored"), "k", buckets=4)
    batch = spark.range(300).select("id", F.lit("new").alias("w")).withColumnRenamed("id", "k")
    batch = batch.unionByName(spark.createDataFrame([(None, "null")], "k bigint, w string"))
    for known in (True, False):
        want = [i for i in range(300) if (i % 3 == 0) == known]
        for small in (True, False):
            if not small:
                tab_fits, tab.fits_broadcast = tab.fits_broadcast, lambda df: False
            try:
                found = tab.rows_by_stored(batch, "stored_rows", "k", known)
                rows = found.collect()
            finally:
                if not small:
                    tab.fits_broadcast = tab_fits
            assert sorted(r.k for r in rows if r.k is not None) == want
            assert sum(r.k is None for r in rows) == known
            if not small:
                plan = found._jdf.queryExecution().executedPlan().toString()
                side = plan[plan.index("SortMergeJoin") : plan.index("SelectedBucketsCount: 4 out of 4")]
                stored_side = side[side.rindex("Sort [__stored") :]
                assert "Exchange" not in stored_side
    spark.sql("DROP TABLE stored_rows")


def test_sketches_of_parts_merge_to_those_of_the_whole(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("day"), (F.col("id") % 2).alias("g"), F.pmod(F.hash("id"), F.lit(5000)).alias("user"), (F.col("id") * 37 % 10_007).alias("v")
    )
    daily = sk.sketch_parts(df, ["day", "g"], "user", "v")
    assert daily.count() == 14
    got = {r.g: r for r in sk.read_sketches(sk.merge_sketches(daily, ["g"]), {"q1": 0.25, "median": 0.5}).collect()}
    for g, rows in df.toPandas().groupby("g"):
        assert got[g].n == len(rows) and abs(got[g].n_distinct - rows.user.nunique()) <= 0.04 * rows.user.nunique()
        for name, p in (("q1", 0.25), ("median", 0.5)):
            assert abs((rows.v <= got[g][name]).mean() - p) < 0.035
    ranked = sk.rank_of(sk.merge_sketches(daily), 5003.0).first()
    assert abs(ranked["rank"] - 0.5) < 0.035
    nulls = spark.createDataFrame([(1, None, None), (1, "a", 2.0)], "day int, user string, v double")
    assert tuple(sk.read_sketches(sk.sketch_parts(nulls, ["day"], "user", "v"), {"m": 0.5}).first()) == (1, 2, 1, 2.0)
