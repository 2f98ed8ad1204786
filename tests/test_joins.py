import pytest
from pyspark.sql import functions as F

from tamarack.operators.joins import fits_broadcast, hot_keys, join_lookup, join_salted


@pytest.fixture(scope="module")
def facts(spark):
    """Key 0 owns a third of the rows; keys from 900 on are not in the lookup."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    return spark.range(5000).select("id", key.cast("bigint").alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    text = F.when(F.col("id") != 7, F.concat(F.lit("n"), "id"))  # one NULL answer
    return spark.range(900).select(F.col("id").alias("k"), text.alias("name"), (F.col("id") * 2).alias("x"))


def rows(df):
    return sorted(map(tuple, df.select("id", "k", "name", "x").collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [0, 10_000])
def test_lookup_equals_plain_join(facts, lookup, how, limit):
    assert rows(join_lookup(facts, lookup, ["k"], how, max_rows=limit)) == rows(facts.join(lookup, "k", how))


def test_hot_key_without_lookup_row(facts, lookup):
    rest = lookup.filter("k <> 0")
    for how in ("inner", "left"):
        assert rows(join_lookup(facts, rest, ["k"], how, max_rows=0)) == rows(facts.join(rest, "k", how))


def test_few_keys_are_hot(facts):
    counts = facts.groupBy("k").count().withColumnRenamed("count", "n")
    assert [r.k for r in hot_keys(counts, ["k"]).collect()] == [0]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_equals_plain_join(facts, lookup, how):
    twice = lookup.union(lookup).select("k", "name", "x")
    cols = ["id", "k"] + (["name", "x"] if how in ("inner", "left") else [])
    got = join_salted(facts, twice, ["k"], how, salts=5).select(cols).collect()
    want = facts.join(twice, "k", how).select(cols).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_size_check(spark):
    assert fits_broadcast(spark.range(10), max_rows=10)
    assert not fits_broadcast(spark.range(11), max_rows=10)
    assert not fits_broadcast(spark.range(10), max_bytes=20)
    assert fits_broadcast(spark.range(0))
