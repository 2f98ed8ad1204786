import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.operators import recommend as rc
from tamarack.plans import REGISTRY
from tamarack.plans.registry import Tables
from tamarack.plans.views import taste
from tamarack.session import materialize


@pytest.fixture(scope="module")
def ratings(spark):
    """Strong user and item effects plus a little noise; user 0 has the most ratings."""
    pairs = spark.range(40 * 60).select((F.col("id") / 60).cast("int").alias("user"), (F.col("id") % 60).cast("int").alias("item"))
    kept = pairs.filter((F.col("user") == 0) | (F.pmod(F.hash("user", "item"), F.lit(3)) > 0))
    noise = F.pmod(F.hash("item", "user"), F.lit(100)) / 100
    return kept.withColumn("rating", (F.col("user") % 5) + (F.col("item") % 4) * 0.5 + noise).cache()


@pytest.fixture(scope="module")
def split(ratings):
    return rc.split_by_key(ratings, ["user", "item"])


def test_split_ignores_partitioning(ratings, split):
    again = rc.split_by_key(ratings.repartition(7).orderBy("rating"), ["user", "item"])[1]
    assert again.exceptAll(split[1]).count() == 0 and again.count() == split[1].count()
    assert split[0].count() + split[1].count() == ratings.count()
    assert 0.15 < split[1].count() / ratings.count() < 0.25
    other = rc.split_by_key(ratings, ["user", "item"], seed=1)[1]
    assert other.exceptAll(split[1]).count() > 0


def test_means_and_interaction(split):
    train = split[0].toPandas()
    want = train.assign(
        u=train.groupby("user").rating.transform("mean"), i=train.groupby("item").rating.transform("mean")
    ).sort_values(["user", "item"])
    want["r"] = want.rating - (want.u + want.i - train.rating.mean())
    got = rc.means_and_interaction(split[0], 17).collect()
    assert [(r.user, r.item) for r in got] == list(zip(want.user[:17], want.item[:17]))
    assert [r.user_item_interaction for r in got] == pytest.approx(list(want.r[:17]))


def test_models_improve_on_each_other(split):
    mean = rc.global_mean_rmse(*split).first().rmse
    bias = rc.bias_only_rmse(*split).first().rmse
    als = rc.als_rmse(*split, rank=10).first().rmse
    als_bias = rc.als_rmse(*split, rank=10, bias=True).first().rmse
    assert bias < mean and als_bias < als and als_bias < mean


def test_unknown_users_drop_out(spark, split):
    new = spark.createDataFrame([(999, 1, 3.0), (1, 1, 2.0)], "user int, item int, rating double")
    assert [r.user for r in rc.join_means(new, split[0]).collect()] == [1]


def test_a_rating_for_each_customer_and_part(spark, root):
    t = Tables(spark, root)
    bought = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    want = {(5_000_000_000 + r.o_custkey, r.l_partkey) for r in bought.select("o_custkey", "l_partkey").collect()}
    got = [(r.user, r.item) for r in taste(t).collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("name", ["als_basic_rmse", "als_bias_rmse"])
def test_factors_learn_on_real_ids(spark, root, name):
    assert [r.learned for r in REGISTRY[name].run(spark, root).collect()] == [True]


def shuffles_held(spark) -> set:
    """Numbers of the shuffles whose files are on disk."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [blocks.apply(i).getName() for i in range(blocks.size())]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def test_steps_leave_no_shuffles_behind(spark, split):
    """Every half-step of ALS shuffles all factors; the files of all of them together were what filled the disk."""
    train, test = (materialize(df, "part") for df in split)
    before = shuffles_held(spark)
    materialize(train.groupBy("user").agg(F.avg("rating")).repartition(5), "means")
    assert not shuffles_held(spark) - before
    prepared = rc.prepare(train, test)
    for steps in (2, 8):
        known = shuffles_held(spark)
        rc.als_rmse(*prepared, rank=4, max_iter=steps)
        end = time.time() + 20
        while len(shuffles_held(spark) - known) > 10 and time.time() < end:  # files go in the background
            time.sleep(0.2)
        assert len(shuffles_held(spark) - known) <= 10


def test_blocks_grow_with_the_factors_a_task_is_sent(spark, monkeypatch):
    """Ten blocks as long as they can be held; more ratings by more others make more blocks, and the error stays."""
    for ratings, others in ((28_800_000, 1_200_000), (173_000_000, 7_200_000), (1_000_000_000, 900_000)):
        blocks = rc.n_blocks(ratings, others, 70)
        sent = others * (1 - np.exp(-ratings / blocks / others))
        assert blocks > 10 and sent * (4 * 70 + 32) <= rc.FACTORS_MB << 20
    assert rc.n_blocks(1 << 40, 100_000, 70) == 10
    rows = spark.range(4000).select((F.col("id") % 80).alias("user"), F.floor(F.col("id") / 80).alias("item"))
    rows = rows.withColumn("rating", (F.col("user") % 5) * 0.5 + (F.col("item") % 3) + 1.0)
    train, test = rc.prepare(*rc.split_by_key(rows, ["user", "item"]))
    want, seen, real = rc.als_rmse(train, test, rank=5).first().rmse, [], rc.ALS
    monkeypatch.setattr(rc, "ALS", lambda **kw: seen.append((kw["numUserBlocks"], kw["numItemBlocks"])) or real(**kw))
    monkeypatch.setattr(rc, "FACTORS_MB", 45 * 52 / (1 << 20))  # 45 others
    assert rc.als_rmse(train, test, rank=5).first().rmse == pytest.approx(want, abs=0.02)
    assert min(seen[0]) > 10
