"""Vectors cut into blocks, and every query block met with every data block."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DATA_BLOCK = 8192  # vectors in a data block, about
QUERY_BLOCK = 2048  # queries in a query block, about


def usable(vector: str) -> Column:
    """Neither null nor empty, and without null, NaN or infinite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd, F.lit(False))


def one_row_per_id(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """The smallest vector of every ``key`` that is not null: repeated rows count once."""
    return vectors.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(vector).alias(vector))


def first_copies(vectors: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """Of rows with equal vectors those with the ``keep`` smallest keys.

    A copy beyond them can be among no query's ``keep - 1`` best: as many copies
    with the same score and smaller keys go before it, besides the query itself.
    """
    order = Window.partitionBy(vector).orderBy(key)
    return vectors.withColumn("__copy", F.row_number().over(order)).filter(F.col("__copy") <= keep).drop("__copy")


def meet_blocks(
    queries: DataFrame,
    data: DataFrame,
    key: str,
    match: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    query_block: int = QUERY_BLOCK,
    data_block: int = DATA_BLOCK,
) -> DataFrame:
    """``match(block of queries, block of data)`` for all pairs of blocks of equal ``dim``.

    Rows are dealt to blocks by the hash of ``key``, so blocks are even and each fits
    in a task whatever the size of the tables. A row travels once to each block of the
    other side.
    """
    n_queries = max(1, -(-queries.count() // query_block))
    n_data = max(1, -(-data.count() // data_block))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("__q", block(n_queries)).withColumn("__d", all_of(n_data))
    right = data.withColumn("__d", block(n_data)).withColumn("__q", all_of(n_queries))
    place = ["__q", "__d", "dim"]
    empty = pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})

    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        return match(queries, data) if len(queries) and len(data) else empty

    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInPandas(run, schema)


def matrix(column: pd.Series, dtype=np.float64) -> np.ndarray:
    """The arrays of a column, all of one length, as rows."""
    return np.stack([np.asarray(v, dtype) for v in column])


def best_by_query(found: DataFrame, k: int, score: str = "score") -> DataFrame:
    """The ``k`` best rows of every query and their rank; ties go to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc(score), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
