import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.operators import ordering
from tamarack.operators.ordering import quantiles, row_index, running_total, select_ranks, value_counts
from tamarack.session import materialize


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows in group 0, half of those with one value."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("int").alias("g"),
        F.when(F.col("id") % 6 == 0, 5.0).otherwise((F.col("id") * 37 % 1009).cast("double")).alias("v"),
        "id",
    )
    return rows


@pytest.mark.parametrize("parts", [1, 8])
def test_row_index_is_the_sorted_position(hot, parts):
    got = row_index(hot.repartition(parts), ["v", "id"], start=1).orderBy("v", "id").collect()
    assert [r.position for r in got] == list(range(1, 3001))


def test_running_total_per_group(hot):
    got = running_total(hot.withColumn("w", F.lit(2)), ["v", "id"], "w", by=["g"]).collect()
    seen = {}
    for r in sorted(got, key=lambda r: (r.g, r.v, r.id)):
        assert r.before == seen.get(r.g, 0)
        seen[r.g] = r.before + 2
    assert all(r.total == seen[r.g] for r in got)


def test_quantiles_match_numpy(hot):
    wanted = {"p0": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: r for r in quantiles(value_counts(hot, "v", ["g"]), "v", wanted, ["g"]).collect()}
    data = hot.toPandas()
    for g, rows in data.groupby("g"):
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(rows["v"], p))


def test_quantiles_of_one_value(spark):
    one = spark.createDataFrame([(4.0,), (None,)], "v double")
    assert quantiles(value_counts(one, "v"), "v", {"m": 0.5}).collect()[0].m == 4.0


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(20,3)"])
def test_quantiles_of_plain_rows(spark, kind):
    """Values over many orders of magnitude, some that differ in the last bits only."""
    numbers = [3**i % (2**53) * (-1) ** i for i in range(33)] + [2**53 + i for i in range(5)] + [7] * 9 + [0]
    if kind == "double":
        numbers = [float(x) for x in numbers] + [10.0**-i for i in range(300)] + [float("inf"), -float("inf")]
    df = spark.createDataFrame([(str(x),) for x in numbers], "x string").select(F.col("x").cast(kind).alias("v"))
    wanted = {f"p{i}": i / 16 for i in range(17)}
    ranks = {n: F.floor(F.lit(p) * (F.col("total") - 1)) for n, p in wanted.items()}
    got = select_ranks(df, "v", ranks).first()
    ordered = sorted(numbers)
    for name, p in wanted.items():
        assert got[name] == ordered[int(np.floor(p * (len(ordered) - 1)))]


def test_groups_of_quantiles_may_be_null(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in quantiles(df, "v", {"m": 0.5}, ["g"], weight=None).collect()}
    assert got == {None: 2.0, "a": 5.0}
    none = quantiles(df.filter("false"), "v", {"m": 0.5}, weight=None).collect()
    assert [r.m for r in none] == [None]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_row_index_takes_one_range_exchange(spark, hot, monkeypatch):
    written = []

    def seen(df, name):
        written.append(plan_of(df).split("Physical Plan")[1])
        return materialize(df, name)

    monkeypatch.setattr(ordering, "materialize", seen)
    got = row_index(hot, ["v", "id"])
    assert len(written) == 1
    assert written[0].count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in written[0]
    assert "Exchange " not in plan_of(got).split("Physical Plan")[1].replace("BroadcastExchange ", "")


def test_quantiles_sort_no_rows(spark, hot, monkeypatch):
    """Every shuffle but those of bins and groups would be a shuffle of rows."""
    plans = []

    def seen(df, name):
        plans.append(plan_of(df).split("Physical Plan")[1])
        return materialize(df, name)

    monkeypatch.setattr(ordering, "materialize", seen)
    quantiles(hot, "v", {"m": 0.5}, ["g"], weight=None).collect()
    assert 2 <= len(plans) <= 5
    for plan in plans:
        assert "rangepartitioning" not in plan
        first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1:]
        assert all("g#" in line for line in first)
