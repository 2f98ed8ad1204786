"""Rating prediction: split, means, biases and ALS."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.joins import join_lookup
from tamarack.operators.ordering import row_index
from tamarack.session import materialize, scratch_root

_SCALE = 1 << 28
BLOCKS = 10  # of users and of items, as MLlib has them, as long as a task can hold what a block asks for
FACTORS_MB = 256  # of the other side's factors that a task may be sent for its block


def split_by_key(
    df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by a hash of the key, whatever the partitioning or order."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *keys))
    place = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")
    in_test = place < int(test_fraction * _SCALE)
    return df.filter(~in_test), df.filter(in_test)


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: root mean squared error."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def global_mean(train: DataFrame) -> DataFrame:
    """One row: mean rating."""
    return train.agg(F.avg("rating").alias("mean"))


def group_mean(train: DataFrame, key: str) -> DataFrame:
    """``(key, <key>_mean, n)``."""
    return train.groupBy(key).agg(F.avg("rating").alias(f"{key}_mean"), F.count(F.lit(1)).alias("n"))


def global_mean_rmse(train: DataFrame, test: DataFrame) -> DataFrame:
    """Error of predicting the training mean everywhere."""
    return rmse(test.withColumn("prediction", global_mean(train).scalar()))


def join_means(df: DataFrame, train: DataFrame) -> DataFrame:
    """Add the training means ``user_mean`` and ``item_mean``.

    Rows whose user or item is not in ``train`` drop out. Both joins keep the
    rows of a very active user, or of a very popular item, spread out.
    """
    joined = df
    for key in ("user", "item"):
        means = materialize(group_mean(train, key), "means")
        # Counts of `train` serve for its own rows; other rows are counted if need be.
        counts = means.select(key, "n") if df is train else None
        joined = join_lookup(joined, means.drop("n"), [key], counts=counts)
    return joined


def baseline(train: DataFrame) -> Column:
    """Prediction from the means alone, over columns added by :func:`join_means`."""
    return F.col("user_mean") + F.col("item_mean") - global_mean(train).scalar()


def means_and_interaction(train: DataFrame, n: int | None = None) -> DataFrame:
    """Ratings with their means and what those leave unexplained, by user and item."""
    rows = join_means(train, train).withColumn("user_item_interaction", F.col("rating") - baseline(train))
    rows = rows.orderBy("user", "item").select(
        "user", "item", "rating", "user_mean", "item_mean", "user_item_interaction"
    )
    return rows if n is None else rows.limit(n)


def bias_only_rmse(train: DataFrame, test: DataFrame) -> DataFrame:
    """Error of predicting from user and item means."""
    return rmse(join_means(test, train).withColumn("prediction", baseline(train)))


def number_ids(df: DataFrame, key: str) -> DataFrame:
    """``(key, number)``: the distinct values of a column, numbered from 0 in their order."""
    known = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return materialize(row_index(known, [key], "number"), "ids")


def prepare(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both parts with their means, the baseline they give, and numbers for users and items; written once.

    For several models of one split. Pairs with a user or item that is not in ``train`` are left out.
    """
    numbers = {}
    for key in ("user", "item"):
        numbers[key] = number_ids(train, key).select(key, F.col("number").cast("int").alias(f"{key}_number"))
    known, parts = materialize(train, "train"), []
    for rows in (known, test):
        joined = join_means(rows, known).withColumn("baseline", baseline(known))
        for key in ("user", "item"):
            joined = join_lookup(joined, numbers[key], [key])
        parts.append(materialize(joined, "prepared"))
    return parts[0], parts[1]


def n_blocks(ratings: int, others: int, rank: int) -> int:
    """Blocks of users (or items) for so many ratings by ``others`` items (or users).

    A task is sent the factors of all others that its block has a rating of, and holds them at once. With few
    blocks those are nearly all others, however many there are; so blocks grow with the ratings.
    """
    most = FACTORS_MB * (1 << 20) / (4 * rank + 32)  # an array of floats each
    if others <= most:
        return BLOCKS
    # A block of r ratings has others * (1 - exp(-r / others)) of them.
    return max(BLOCKS, math.ceil(ratings / (-math.log1p(-most / others) * others)))


def als_rmse(
    train: DataFrame,
    test: DataFrame,
    rank: int = 70,
    max_iter: int = 5,
    reg: float = 0.01,
    seed: int = 123,
    bias: bool = False,
) -> DataFrame:
    """Error of alternating least squares; with ``bias`` it learns the interaction only.

    Ids of any type and size: users and items are numbered first, as MLlib asks for
    32-bit integers. Pairs with a user or item that is not in ``train`` are left out.
    Takes the parts as they are or from :func:`prepare`.
    """
    scratch_root(train.sparkSession)  # ALS cuts its lineage there on long runs
    if "user_number" not in train.columns:
        train, test = prepare(train, test)
    target = F.col("rating") - F.col("baseline") if bias else F.col("rating")
    learn = train.select("user_number", "item_number", target.cast("float").alias("__target"))
    n, users, items = learn.agg(F.count(F.lit(1)), F.max("user_number") + 1, F.max("item_number") + 1).first()
    als = ALS(
        maxIter=max_iter,
        rank=rank,
        regParam=reg,
        seed=seed,
        userCol="user_number",
        itemCol="item_number",
        ratingCol="__target",
        numUserBlocks=n_blocks(n, items or 0, rank),
        numItemBlocks=n_blocks(n, users or 0, rank),
        coldStartStrategy="drop",
        # Every half-step shuffles each factor to all blocks; a checkpoint lets the files of the steps before go.
        checkpointInterval=1,
    )
    scored = als.fit(learn).transform(test)
    if bias:
        scored = scored.withColumn("prediction", F.col("prediction") + F.col("baseline"))
    return rmse(scored)
